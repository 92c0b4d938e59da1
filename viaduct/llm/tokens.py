"""Public tokenizers on executors."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from typing import Any

#: Long texts are handed to the library in pieces of about so many characters.
PIECE_CHARS = 100_000
#: White space of a text that is also white space to the tokenizer's own pattern.
SPACE = re.compile(r"[ \t\n\r]")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str) -> Any:
    """The tokenizer of a .json file, one copy a worker; its own threads are off, as Spark has a task for each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def word_pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """Cuts of a text at white space, for tokenizers that drop white space: pieces are encoded as in the whole text.

    A run of over limit characters without white space stays whole.
    """
    if len(text) <= limit:
        return [text]
    out, start = [], 0
    while len(text) - start > limit:
        m = SPACE.search(text, start + limit)
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    return [*out, text[start:]]
