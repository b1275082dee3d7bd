"""Writers and the line layouts they share."""

from minewright.sinks.text import (
    itemset_lines,
    kv_lines,
    merge_sorted,
    read_embeddings,
    tag_lines,
    topic_lines,
    write_embeddings,
    write_itemsets,
    write_kv_sorted,
    write_tag_lines,
    write_topic_report,
    write_vocab,
)

__all__ = [
    "itemset_lines",
    "kv_lines",
    "merge_sorted",
    "read_embeddings",
    "tag_lines",
    "topic_lines",
    "write_embeddings",
    "write_itemsets",
    "write_kv_sorted",
    "write_tag_lines",
    "write_topic_report",
    "write_vocab",
]
