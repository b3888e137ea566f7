"""Ids of many texts at once, put together from the ids of their distinct words."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SLICE = 1 << 16


@contextmanager
def no_cycles() -> Iterator[None]:
    """No search for garbage cycles meanwhile: it would walk large word tables again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def by_word(texts: pa.Array, lookup: Callable[[list[str]], list[bytes | None]], dtype: np.dtype,
            whole: Callable[[str], bytes], first: Callable[[list[str]], list[bytes]] | None = None,
            head: bytes = b"", tail: bytes = b"") -> pa.Array:
    """A binary array: for each text ``head``, the ids of its words in order, ``tail``.

    Texts are split at single spaces. ``lookup`` gives the ids of words that follow
    a space, None for those whose ids depend on their neighbours: a text with such a
    word is coded by ``whole``. ``first`` codes words at a text's start (else as the
    others). Null and empty texts are head and tail alone.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return pa.array([], pa.large_binary())
    split = pc.split_pattern(texts, " ")
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary.to_pylist()
    ids = lookup(words)
    size = len(words)
    starts = offsets[:-1]
    if first is not None:
        opening = [words[c] for c in codes[starts]]
        ids = ids + first(opening)
        codes[starts] = size + np.arange(n)
    odd = np.fromiter((i is None for i in ids), bool, len(ids))
    odd_text = np.add.reduceat(odd[codes], starts) > 0
    length = pc.utf8_length(texts).to_numpy()
    odd_text &= length > 0
    ids = [b"" if i is None else i for i in ids] + [head, tail, b""]
    h = len(ids) - 3
    codes[starts[length == 0]] = h + 2  # an empty text is one empty word
    codes = np.insert(codes, np.concatenate([offsets[1:], starts]), np.repeat([h + 1, h], n))
    blob = np.frombuffer(b"".join(ids), dtype)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // dtype.itemsize
    del ids, coded, split
    begin = np.cumsum(sizes) - sizes
    each = sizes[codes]
    ends = np.cumsum(each)
    out = np.empty(ends[-1], dtype)
    for lo in range(0, len(codes), _SLICE):  # the places of all ids at once would take far more than the ids
        part = slice(lo, lo + _SLICE)
        first_id = ends[lo] - each[lo]
        last_id = ends[part][-1]
        place = np.repeat(begin[codes[part]] - (ends[part] - each[part]), each[part])
        place += np.arange(first_id, last_id)
        out[first_id:last_id] = blob[place]
    borders = np.r_[0, ends[offsets[1:] + 2 * np.arange(1, n + 1) - 1]]
    if odd_text.any():
        parts = [head + whole(texts[i].as_py()) + tail if odd_text[i]
                 else out[borders[i]:borders[i + 1]].tobytes() for i in range(n)]
        return pa.array(parts, pa.large_binary())
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer((borders * dtype.itemsize).astype(np.int64)), pa.py_buffer(out)])
