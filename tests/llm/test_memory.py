"""What a worker keeps between the stages of a pipeline, and what a lookup in a cache costs."""

import numpy as np
import pyarrow as pa

from tickloom.llm import common, packing


def resident() -> int:
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) // 1024 for line in f if line.startswith("VmRSS"))


def test_memory_of_a_dropped_cache_goes_back_to_the_system(monkeypatch):
    held = [bytes(np.full(1000 + i % 7, 1, np.uint8)) for i in range(300_000)]
    blocks = [pa.array(np.arange(4_000) + i).take(pa.array(np.arange(4_000))) for i in range(6_000)]
    kept = held[::1000], blocks[::100]
    monkeypatch.setattr(common, "CACHES", {"other": lambda: (held.clear(), blocks.clear())})
    before = resident()
    common.keep_cache_of("")
    assert len(kept[0]) == 300 and before - resident() > 300


def test_a_lookup_does_not_go_over_the_older_generation():
    class Older(dict):
        def __iter__(self):
            raise AssertionError("all keys are read")

    cache = packing.Cache(10)
    cache.young, cache.old = {"a": b"1"}, Older({"b": b"2", "c": b"3"})
    assert cache.missing({"a", "b", "d"}) == {"d"} and cache.young == {"a": b"1", "b": b"2"}
