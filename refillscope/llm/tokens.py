"""Exact token ids of a word-level BPE tokenizer, by remembered chunks between white space.

The tokenizer never joins text across a blank or a line end, so the ids of a text are the
ids of its chunks one after the other. Ids are kept as little-endian unsigned 32-bit
integers, ready to be joined, cut and hashed.
"""

from __future__ import annotations

import re
import struct

from refillscope.llm.shared import release_unused

_ENCODERS: dict[str, _Chunks] = {}

# A worker remembers so many chunks that came again and as many before them, so many others, and no longer ones.
_REMEMBERED = 200_000
_ONCE = 200_000
_LONGEST = 48

# A chunk that ends in ASCII punctuation after a Latin letter, which stays one in lower case:
# the tokenizer splits between them.
_TAIL = re.compile(r"(.*[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)


class _Chunks(dict):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._before: dict[str, bytes] = {}
        # Most chunks are rare: only what comes again goes on to be remembered for long.
        self._once: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        raw = self._before.get(chunk)
        if raw is None:
            raw = self._once.pop(chunk, None)
        again = raw is not None
        if raw is None and "<|" not in chunk:  # special tokens are taken as they are
            lower = chunk.lower() if chunk.isascii() else chunk  # the tokenizer lower-cases
            parts = _TAIL.fullmatch(lower)
            if parts:
                raw = self[parts[1]] + self[parts[2]]
            elif lower != chunk:
                raw = self[lower]
        if raw is None:
            ids = self._tokenizer.encode(chunk, add_special_tokens=False).ids
            raw = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) > _LONGEST:
            return raw
        if again:
            if len(self) >= _REMEMBERED:
                self._before = dict(self)
                self.clear()
            self[chunk] = raw
        else:
            if len(self._once) >= _ONCE:
                self._once.clear()
            self._once[chunk] = raw
        return raw


def default_tokenizer() -> str:
    """Path of the public word-level vocabulary (49,408 ids)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> _Chunks:
    """The chunk encoder of a tokenizer file, loaded once in a worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Chunks(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give back the memory of the encoders that earlier tasks of this worker loaded, chunks and all."""
    _ENCODERS.clear()
    release_unused()


def chunks_of(text: str | None) -> list[str]:
    """Pieces between blanks, tabs and line ends: places where the tokenizer always splits."""
    if not text:
        return []
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def token_bytes(text: str | None, chunks: _Chunks) -> bytes:
    """All ids of the text, four bytes each."""
    return b"".join(map(chunks.__getitem__, chunks_of(text)))
