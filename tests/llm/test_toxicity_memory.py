import tracemalloc

import numpy as np
from pyspark import cloudpickle

from ledgerflow.llm.toxicity import Index, scored


def _index(examples, terms):
    rng = np.random.default_rng(3)
    row, term = np.divmod(np.unique(rng.integers(0, examples * terms, examples * 6)), terms)
    names = np.sort(rng.integers(1, 1 << 63, terms).astype(np.uint64))
    return Index.build(names, np.arange(examples), (np.arange(examples) % 3 == 0).astype(float), row, term, np.ones(len(row), np.int64))


def test_a_worker_holds_little_besides_the_scores():
    """Neither copies of all scores nor a table of all terms."""
    index, n = _index(4096, 50_000), 256
    row, term = np.repeat(np.arange(n), 5), np.sort(np.random.default_rng(5).integers(0, 50_000, (n, 5)), axis=1).ravel()
    tracemalloc.start()
    slots, near = index.nearest(row, term, np.ones(len(row), np.int64), n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    tracemalloc.clear_traces()
    numbers = index.numbers([[int(index.names[7]), 0], [], [int(index.names[-1])], [(1 << 64) - 1]])
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert numbers == [[7], [], [49_999], []]
    assert peak < 3 * n * index.often.shape[1] * 8 and held < 1 << 20
    assert (np.diff(near, axis=1) <= 1e-12).all() and slots.shape == near.shape == (n, 50)


def _base(array):
    while isinstance(array, np.ndarray) and array.base is not None:
        array = array.base
    return array


def test_a_worker_maps_the_model(spark, tmp_path, monkeypatch):
    """It isn't in the task, of which each worker would have it packed and unpacked."""
    index, sent = _index(4096, 50_000), []
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    kind, real = type(docs), type(docs).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, **b: sent.append(len(cloudpickle.dumps(f))) or real(self, f, *a, **b))
    assert scored(docs, index).count() == 2
    assert len(sent) == 1 and sent[0] < 100_000 < index.weights.nbytes
    there = Index.load(index.save(f"file://{tmp_path}/deep/model"))
    for name, value in vars(index).items():
        own = getattr(there, name)
        assert np.array_equal(own, value) and (not isinstance(value, np.ndarray) or own.dtype == value.dtype)
    assert type(_base(there.weights)).__name__ == "mmap"
