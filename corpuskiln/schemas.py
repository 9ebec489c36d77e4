"""Declared schemas of the rows that sources read and stages hand on."""

RAW_FILE = "filename string, filetype string, content string"
LOAD_RESULT = "filename string, load_ok boolean, file string, error string, file_deps array<string>"
RUN_RESULT = "filename string, load_ok boolean, returncode int, stdout string, stderr string, cmd array<string>, cwd string, error string"
VERIFIED_SLICE = "filename string, filetype string, content string, n_imports_original int, n_imports_final int"
COMMENT = "filename string, sha1 string, comment string, keep boolean, snippet string"
COMMENT_INDEX = "filename string, span_start int, span_end int, kind string, comment_sha1 string, kept boolean, length int"
FILE_METRICS = (
    "filename string, sha1 string, bytes int, lines int, avg_line_len double, max_line_len int, non_ascii_ratio double, binary_like boolean, enc_total_matched int, enc_max_run int, "
    "enc_fraction double, enc_hits_base64 int, enc_hits_hexbytes int, enc_hits_unicode int, num_tokens_lang int, k_shingle int, num_shingles int, hexnum_ratio double, num_tokens_model int, junk_path boolean"
)
SIMILAR_PAIR = "a string, b string, jaccard double, a_shingles int, b_shingles int, union_shingles int, intersect_shingles int"
CLUSTER = "cluster string, size bigint, kept string, dropped_count bigint"
MCC_SUMMARY = "json_path string, imports array<string>, imports_count int, num_definitions int, num_declarations int, num_types int, num_declarations_with_mcc int, total_mcc bigint, max_mcc int, avg_mcc double"
SPLIT = "filename string, avg_mcc_difficulty_bucket string, split string"
MASKED_EXAMPLE = "filename string, def_name string, def_params array<string>, masked_source string, target_definition string, hole_name string"
ALPACA = "instruction string, input string, output string"
QA_LIST = "filename string, filetype string, content string, qa_pairs array<struct<question:string,answer:string>>"
CHAT_EXAMPLE = "filename string, bucket string, scenario string, messages array<struct<role:string,content:string>>"
TOKEN_ROW = "filename string, input_ids array<int>, n_tokens int"
TOKEN_CHUNK = "filename string, chunk_index int, input_ids array<int>, n_tokens int"
MARKDOWN_CHUNK = "id string, text string, source string, section_start int, section_end int, start_char int"
CACHE_ENTRY = "key string, value string, ts timestamp"
DECISION = "sha1 string, keep boolean"
EVAL_TASK = "task string, task_id string, test_list array<string>, test_setup_code string, type string"
