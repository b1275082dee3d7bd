"""Readers that turn text files into the library's frames."""

from minewright.sources.text import (
    read_documents,
    read_labelled_csv,
    read_sentences,
    read_tagged_corpus,
    read_transactions,
    read_vocab,
    read_word_vectors,
)

__all__ = [
    "read_documents",
    "read_labelled_csv",
    "read_sentences",
    "read_tagged_corpus",
    "read_transactions",
    "read_vocab",
    "read_word_vectors",
]
