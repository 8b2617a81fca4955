"""Places of the public vocabulary files; the queries take them as parameters."""

from __future__ import annotations


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
