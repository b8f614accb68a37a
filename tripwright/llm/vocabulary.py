"""Places of the public vocabulary files; any other file of the same kind can be given to the operators."""

from __future__ import annotations

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
