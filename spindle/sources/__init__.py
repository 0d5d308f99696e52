from spindle.sources.tables import read_table, TABLES  # noqa: F401
from spindle.sources.text import (  # noqa: F401
    read_lines, sentences, parse_csv_layout_a, parse_csv_layout_b, parse_csv_quoted, parse_tsv_label_first,
    parse_tsv_text_first, one_class_text, read_libsvm, write_libsvm, SENTENCE_SCHEMA,
)
