"""Golomb-coded exchange of sorted fingerprints.

Senders (shards of the input) cut their sorted fingerprints into one list per owner; an owner holds
a contiguous range of fingerprints. A list travels as Golomb codes (divisor a power of two) of its
differences. The owner answers each list with a bitmap, one bit for each entry of the list, in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LIST_SCHEMA = "shard long, owner long, n long, low int, code binary"
REPLY_SCHEMA = "shard long, owner long, n long, bitmap binary"


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once; much faster for 64-bit values than numpy's own, which hashes."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def golomb_low_bits(n: int, span: int) -> int:
    """Bits sent as they are: about log2 of the mean difference."""
    return max(0, (span // max(n, 1)).bit_length() - 1)


def golomb_encode(gaps: np.ndarray, low: int) -> bytes:
    """Quotients in unary, then the remainders: whole bytes first, the odd bits after them."""
    high = (gaps >> np.uint64(low)).astype(np.int64)
    ends = np.cumsum(high + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    out = [np.packbits(unary).tobytes()]
    raw = np.ascontiguousarray(gaps).astype("<u8").view(np.uint8).reshape(-1, 8)
    if low >= 8:
        out.append(raw[:, : low // 8].tobytes())
    if low % 8:
        out.append(np.packbits(np.unpackbits(raw[:, low // 8, None], axis=1, bitorder="little")[:, : low % 8]).tobytes())
    return len(out[0]).to_bytes(8, "little") + b"".join(out)


def golomb_decode(code: bytes, n: int, low: int) -> np.ndarray:
    if n == 0:
        return np.empty(0, np.uint64)
    size = int.from_bytes(code[:8], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, size, 8)))[:n]
    high = np.diff(ends, prepend=-1) - 1
    raw = np.zeros((n, 8), np.uint8)
    at = 8 + size
    if low >= 8:
        k = low // 8
        raw[:, :k] = np.frombuffer(code, np.uint8, n * k, at).reshape(n, k)
        at += n * k
    if low % 8:
        bits = np.unpackbits(np.frombuffer(code, np.uint8, -1, at), count=n * (low % 8)).reshape(n, low % 8)
        raw[:, low // 8] = np.packbits(bits, axis=1, bitorder="little")[:, 0]
    return raw.view("<u8")[:, 0] + (high.astype(np.uint64) << np.uint64(low))


def owner_width(bits: int, owners: int) -> int:
    return -(-(1 << bits) // owners)


def cuts(values: np.ndarray, bits: int, owners: int) -> list[tuple[int, int, int]]:
    """(owner, begin, end) of each owner that gets part of ``values`` (sorted uint64)."""
    if not len(values):
        return []
    width = owner_width(bits, owners)
    first, last = int(values[0]) // width, int(values[-1]) // width
    marks = np.array([o * width for o in range(first + 1, last + 1)], np.uint64)
    at = [0, *np.searchsorted(values, marks).tolist(), len(values)]
    return [(o, a, b) for o, (a, b) in enumerate(zip(at, at[1:]), first) if b > a]


def _coded(part: np.ndarray, owner: int, width: int) -> tuple[int, int, bytes]:
    gaps = np.empty(len(part), np.uint64)
    gaps[0] = part[0] - np.uint64(owner * width)
    np.subtract(part[1:], part[:-1], out=gaps[1:])
    low = golomb_low_bits(len(part), width)
    return len(part), low, golomb_encode(gaps, low)


def open_list(owner: int, n: int, low: int, code: bytes, bits: int, owners: int) -> np.ndarray:
    """The fingerprints of one list."""
    out = np.cumsum(golomb_decode(code, n, low), dtype=np.uint64)
    return out + np.uint64(owner * owner_width(bits, owners))


def list_frame(shard: int, values: np.ndarray, bits: int, owners: int) -> pd.DataFrame:
    width = owner_width(bits, owners)
    rows = [(shard, o, *_coded(values[a:b], o, width)) for o, a, b in cuts(values, bits, owners)]
    return pd.DataFrame(rows, columns=["shard", "owner", "n", "low", "code"])


def answer(lists: DataFrame, bits: int, owners: int, earlier: bool = False) -> DataFrame:
    """Replies to ``lists``: bit i says that entry i occurs twice among the owner's lists.

    A sender lists a fingerprint twice to say that it has met it twice itself. With ``earlier``, bit
    i says instead that a list of a smaller shard has the entry.
    """

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        parts = [open_list(r.owner, r.n, r.low, r.code, bits, owners) for r in pdf.itertuples()]
        every = np.sort(np.concatenate(parts))
        twice = distinct(every[1:][every[1:] == every[:-1]])
        del every
        met = np.zeros(len(twice), bool)
        maps = []
        for part in parts:
            at = np.searchsorted(twice, part)
            hit = at < len(twice)
            hit[hit] = twice[at[hit]] == part[hit]
            if earlier:
                own = at[hit]
                hit[hit] = met[own]
                met[own] = True
            maps.append(np.packbits(hit).tobytes())
        return pd.DataFrame({"shard": pdf["shard"], "owner": pdf["owner"], "n": pdf["n"], "bitmap": maps})

    return lists.groupBy("owner").applyInPandas(merge, REPLY_SCHEMA)


def open_bitmap(bitmap: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool)
