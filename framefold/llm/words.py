"""Words of many texts at once, cut from the bytes of an Arrow batch without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def _not(*ranges: tuple[int, int]) -> np.ndarray:
    keep = np.ones(256, bool)
    for low, high in ranges:
        keep[low : high + 1] = False
    return keep


#: Bytes of words ``[^\x20\x09-\x0D]+``.
UNSPACED = _not((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in texts whose A-Z are lower-cased.
ALPHANUMERIC = _not((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``text``, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


class Words:
    """The words of the texts of one piece, numbered through.

    ``data`` holds the bytes of the texts, ``starts`` and ``ends`` the place of each word in it, ``first``
    the number of each text's first word and, at its end, the number of words. A null text has none.
    """

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, fold: bool = False):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        raw = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.empty(0, np.uint8)
        self.data = LOWERED[raw] if fold else raw
        offsets = offsets - low
        inside = word_bytes[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[offsets] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self._inside = inside

    def encode(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words, and the distinct words by that number."""
        offsets = np.concatenate(([0], np.cumsum(self.ends - self.starts)))
        flat = pa.Array.from_buffers(
            pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[self._inside])]
        ).dictionary_encode()
        return flat.indices.to_numpy(zero_copy_only=False), flat.dictionary

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Each text's words marked in ``keep``, joined by one space."""
        chosen = np.flatnonzero(keep)
        bounds = np.searchsorted(chosen, self.first)
        lengths = self.ends[chosen] - self.starts[chosen] + 1
        last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        lengths[last] -= 1
        at = np.concatenate(([0], np.cumsum(lengths)))
        index = np.arange(at[-1]) + np.repeat(self.starts[chosen] - at[:-1], lengths)
        spaces = np.delete(at[1:] - 1, last)
        index[spaces] = 0
        out = self.data[index]
        out[spaces] = 0x20
        return pa.Array.from_buffers(
            pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(at[bounds]), pa.py_buffer(out)]
        ).cast(pa.string())
