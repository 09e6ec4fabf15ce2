"""Schemas of the records, as DDL."""

LAYOUT_LINE = "doc string, page int, line_no int, text string, size double, bold boolean, x0 double, y0 double, x1 double, y1 double"
PAGE_TABLE = "doc string, page int, table_no int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>"
BLOCK = "doc string, block_idx int, kind string, text string, level int, rows array<array<string>>, page int"
CHUNK = "id string, doc string, section_path array<string>, text string, rows array<array<string>>, start_page int, end_page int"
VECTOR_ROW = "id string, document string, doc string, section_path string, start_page int, end_page int, embedding array<float>"
HIT = "qid string, rank int, id string, score double, text string, doc string, section_path string, start_page int, end_page int"
QA = "id string, question string, answer string, sources array<string>, evidence array<string>, answerable boolean"
SNAPSHOT = "qid string, set string, answerable boolean, route string, k int, hits array<struct<chunk_id: string, doc: string, section_path: string, page: array<int>, score: double>>"
ANSWER = (
    "id string, set string, question string, gold_answer string, answerable boolean, sources array<string>, mode string, top1 double, "
    "topk array<struct<id: string, doc: string, section: string, page: array<int>>>, rejected boolean, answer string, "
    "citations struct<valid: int, invalid: int, none: boolean>, error string"
)
JUDGE = (
    "faithfulness double, faithfulness_reason string, citation double, citation_reason string, answer_accuracy double, "
    "answer_accuracy_reason string, rejection double, rejection_reason string, notes string"
)
