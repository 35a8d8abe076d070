"""Words and word shingles of text batches as 64-bit hashes, in NumPy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

# Multipliers of the splitmix64 finaliser and of the rolling combination.
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)

_LENGTH = np.uint64(0x8CB92BA72F3D8DD7)
# Bytes that are hashed together, so many that their arrays fit a core's cache; the longest word that is hashed by blocks.
_CHUNK = 1 << 17
_LONG_WORD = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_A
    values = (values ^ (values >> np.uint64(27))) * _MIX_B
    return values ^ (values >> np.uint64(31))


# The first bytes of a block, by their number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _chunks(texts) -> list[tuple[bytes, list[int]]]:
    """Texts in UTF-8 with A-Z lower-cased, joined by line ends up to ``_CHUNK`` bytes; where each begins.

    The one that is open at the end of a chunk goes on in the next: a very long text is cut
    between words, and its later parts have no beginning of their own.
    """
    out, parts, begins, size = [], [], [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
        if size and size + len(raw) > _CHUNK:
            out.append((b"\n".join(parts), begins))
            parts, begins, size = [], [], 0
        begins.append(size)
        at = 0
        while len(raw) - at > _CHUNK:
            cut = max(raw.rfind(x, at, at + _CHUNK) for x in (b" ", b"\n"))
            if cut <= at:
                break  # no blank in sight: this chunk is longer
            parts.append(raw[at:cut])
            out.append((b"\n".join(parts), begins))
            # The blank or line end itself begins the next part.
            parts, begins, size, at = [], [], 0, cut
        parts.append(raw[at:])
        size += len(raw) - at + 1
    if parts:
        out.append((b"\n".join(parts), begins))
    return out


def _hash_words(raw: bytes, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of each word of a chunk, and the chunk's bytes. A word is hashed by its blocks of 8 bytes."""
    padded = np.frombuffer(raw + bytes(8), dtype=np.uint8)
    buffer = padded[:-8]
    inside = np.zeros(len(buffer) + 2, dtype=bool)
    np.logical_not(outside[buffer], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # The 8 bytes from each place on.
    blocks = np.ndarray(len(buffer) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    hashes = mix((blocks[starts] & _FIRST[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * _LENGTH)
    rows, at = np.flatnonzero((lengths > 8) & (lengths <= _LONG_WORD)), 8
    while len(rows):
        block = blocks[starts[rows] + at] & _FIRST[np.minimum(lengths[rows] - at, 8)]
        hashes[rows] = mix(hashes[rows] * _STEP + block)
        at += 8
        rows = rows[lengths[rows] > at]
    for k in np.flatnonzero(lengths > _LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : ends[k]])
    return hashes, starts, buffer


def word_hashes(texts, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after the other, and the number of words of each.

    Words are what ASCII white space (space, tab, LF, VT, FF, CR), or the bytes marked in
    ``outside`` (blank and LF among them), separate, with A-Z in lower case, in UTF-8.
    """
    hashes, counts, seen = [], np.zeros(len(texts), dtype=np.int64), 0
    for raw, begins in _chunks(texts):
        own, starts, _ = _hash_words(raw, outside)
        hashes.append(own)
        # Words before the first beginning go on with the text before.
        at = np.searchsorted(starts, [*begins, len(raw) + 1])
        if at[0]:
            counts[seen - 1] += at[0]
        counts[seen : seen + len(begins)] += np.diff(at)
        seen += len(begins)
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), counts


def _passed(marks, starts: np.ndarray) -> np.ndarray:
    """How many of the ascending marks lie at or before each of the ascending starts."""
    at = np.searchsorted(starts, marks)
    return np.repeat(np.arange(len(at) + 1), np.diff(at, prepend=0, append=len(starts)))


def line_hashes(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words; then of each line with words: number of words, text, and line number in it."""
    hashes, counts, owner, number = [], [], [], []
    seen = open_lines = 0
    for raw, begins in _chunks(texts):
        own, starts, buffer = _hash_words(raw)
        ends = np.flatnonzero(buffer == 10)
        line = _passed(ends, starts)
        first = np.searchsorted(ends, begins)
        text = _passed(begins, starts) - 1
        # Lines before the first beginning go on with the text before, which is at this line.
        within = np.where(text >= 0, line - first[np.maximum(text, 0)] if len(first) else line, line + open_lines)
        place = (text + seen) * (1 << 40) + within
        runs = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, dtype=np.int64)
        hashes.append(own)
        counts.append(np.diff(np.append(runs, len(place))))
        owner.append(text[runs] + seen)
        number.append(within[runs])
        open_lines = len(ends) - first[-1] if begins else open_lines + len(ends)
        seen += len(begins)
    if not hashes:
        return (np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 3)
    counts, owner, number = (np.concatenate(x) for x in (counts, owner, number))
    # A line that a cut divides is one line.
    new = np.ones(len(counts), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])
    heads = np.flatnonzero(new)
    return np.concatenate(hashes), np.add.reduceat(counts, heads) if len(heads) else counts, owner[heads], number[heads]


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of every ``width``-word shingle; owners are positions in ``counts``, ascending.

    An owner of fewer words has its whole sequence as one shingle, one without words none.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    if width == 1:
        return mix(hashes), owner
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))
    short = counts[owner] < width
    rolled = hashes.copy()
    for k in range(1, width):
        ahead = np.zeros_like(hashes)
        if k < len(hashes):
            ahead[:-k] = hashes[k:]
        # Short sequences stop at their end; their length tells them from longer ones.
        ahead = np.where(left > k, ahead, np.where(short, counts[owner].astype(np.uint64), ahead))
        rolled = rolled * _STEP + ahead
    first = np.zeros(len(hashes), dtype=bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    keep = np.where(short, first, left >= width)
    return mix(rolled[keep]), owner[keep]


def distinct_sets(values: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of each owner, sorted; their owners; and where each owner's begin (and the end)."""
    values = values.copy()
    bounds = np.searchsorted(owner, np.arange(owners + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, owner, np.searchsorted(owner, np.arange(owners + 1))


def digest(values: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a sorted set, as two signed 64-bit integers."""
    raw = xxhash.xxh3_128_digest(values.tobytes())
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def digests(values: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """``digest`` of the sets ``values[bounds[i]:bounds[i + 1]]``: as bytes, and as rows of two integers."""
    raw, ends = memoryview(values.tobytes()), (8 * bounds).tolist()
    found = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return found, np.frombuffer(b"".join(found), dtype=">i8").astype(np.int64).reshape(-1, 2)


def rank_in_group(group: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    if not len(group):
        return np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
