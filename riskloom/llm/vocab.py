"""Public vocabulary files."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import public_tokenizers
import tiktoken


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


@functools.cache
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def parts(texts: list[str], size: int = 4_000_000) -> Iterator[list[str]]:
    """The texts in lists of about so many characters, so that working memory is bounded."""
    part, n = [], 0
    for text in texts:
        part.append(text)
        n += len(text)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


@functools.cache
def encoding_of(path: str) -> tiktoken.Encoding:
    """Encoder of a rank file; strings of special tokens are ordinary text."""
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})
