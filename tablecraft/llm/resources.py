"""Files that are installed beside the library."""

from __future__ import annotations


def tokenizer_file(name: str) -> str:
    """Path of an installed public tokenizer; every executor has the same files."""
    import public_tokenizers

    return public_tokenizers.path(name)
