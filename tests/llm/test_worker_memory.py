"""What the operators' Python workers hold while they hash, and what they keep."""

import tracemalloc

import numpy as np
import pyarrow as pa
from surfrank.llm import substring, text


def _peak_mb(f):
    tracemalloc.start()
    try:
        out = f()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_hashing_is_bounded_by_slices(monkeypatch):
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(50_000)])
    texts = pa.chunked_array([pa.array([" ".join(rng.choice(words, 3000)) for _ in range(200)])])  # about 4 MB
    monkeypatch.setattr(text, "_POWERS", {})
    (hashes, starts, offsets), mb = _peak_mb(lambda: substring._windows(texts, 35))
    assert len(hashes) == len(starts) == 200 * (3000 - 34) and offsets[-1] == 600_000
    assert mb < 40 and sum(p.nbytes for p in text._POWERS.values()) < 6e6


def test_slices_of_windows_change_nothing(monkeypatch):
    rng = np.random.default_rng(6)
    words = rng.choice(np.array(["a", "bb", "c", "dd"]), 4000).tolist()
    texts = pa.chunked_array([pa.array([" ".join(words[k : k + n]) for k, n in ((0, 3), (3, 900), (100, 0), (400, 34), (3, 900), (903, 2000))])])
    whole = substring._windows(texts, 35)
    monkeypatch.setattr(substring, "SLICE_WINDOWS", 7)
    monkeypatch.setattr(text, "SLICE_BYTES", 50)
    for a, b in zip(whole, substring._windows(texts, 35)):
        assert a.tolist() == b.tolist()


def test_a_bucket_is_met_without_copies():
    rng = np.random.default_rng(7)
    own = [np.unique(rng.integers(0, 1 << 62, 200_000, dtype=np.uint64)) for _ in range(8)]
    own[1] = np.unique(np.append(own[1], own[0][:50]))
    again = np.zeros(len(own[2]), dtype=bool)
    again[7] = True
    flags = [np.packbits(again if k == 2 else np.zeros(len(s), dtype=bool)).tobytes() for k, s in enumerate(own)]
    bucket = pa.table({"chunk": list(range(8)), "bucket": [0] * 8, "hashes": pa.array([s.tobytes() for s in own], pa.binary()), "again": pa.array(flags, pa.binary())})
    met, mb = _peak_mb(lambda: substring._meet(bucket))
    bits = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(s)).astype(bool) for x, s in zip(met.column("bits").to_pylist(), own)]
    assert own[0][bits[0]].tolist() == own[0][:50].tolist() == own[1][bits[1]].tolist()
    assert np.flatnonzero(bits[2]).tolist() == [7] and not any(b.any() for b in bits[3:])
    assert mb < 2.5 * 8 * 1.6  # MB that were sent: 12.8
