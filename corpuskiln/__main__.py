"""Commands: crawl, reflow, variants, index.  ``python -m corpuskiln COMMAND --help`` has their options."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from corpuskiln.functions import machines
from corpuskiln.operators import code_graph, comments
from corpuskiln.session import local_session, ship
from corpuskiln.sources import files


def main() -> None:
    parser = argparse.ArgumentParser(prog="corpuskiln")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("crawl", "source files to JSON lines"), ("reflow", "files whose lists are wrapped anew"), ("variants", "chunks of the three comment variants"), ("index", "definitions of JSON files by complexity")):
        one = commands.add_parser(name, help=text)
        one.add_argument("inputs", nargs="+")
        one.add_argument("--out", required=True)
        one.add_argument("--strip", help="prefix to take off file names")
        one.add_argument("--append", action="store_true")
        one.add_argument("--width", type=int, default=80)
    args = parser.parse_args()
    spark = local_session()
    ship(spark)
    mode = "append" if args.append else "overwrite"
    if args.command == "index":
        defs = code_graph.definitions(files.definition_files(spark, args.inputs[0]))
        files.write_index(code_graph.definition_stats(defs), args.out, mode)
        return
    rows = files.crawl(spark, args.inputs, prefix=args.strip)
    if args.command == "crawl":
        files.write_json_lines(rows, args.out, mode)
    elif args.command == "reflow":
        new = rows.withColumn("new", machines.over_text(lambda s: machines.reflow_sequences(s, args.width), "string")(F.col("content")))
        files.write_json_lines(new.filter("new <> content").select("filename", "filetype", F.col("new").alias("content")), args.out, mode)
    else:
        files.write_by(comments.build_variants(rows), args.out, "variant", mode)


if __name__ == "__main__":
    main()
