"""Language ID on texts of many MB: pieces give what the whole text gives, in bounded memory."""

import tracemalloc

import numpy as np

from quietude.llm import language_id as L
from quietude.llm.arrow_text import RUN_BYTES


def model(languages: int = 3) -> L.Model:
    rng = np.random.default_rng(1)
    return L.Model({}, (), {}, rng.normal(size=(languages, L.DIMS)).astype(np.float32), rng.normal(size=languages),
                   np.log(rng.random((languages, L.DIMS)) / L.DIMS).astype(np.float32), -9.0, 1.0)


def test_pieces_hold_every_trigram_once():
    for size in (RUN_BYTES, RUN_BYTES + 1, RUN_BYTES + 2, RUN_BYTES + 3, 2 * RUN_BYTES + 2, 2 * RUN_BYTES + 5):
        data = np.random.default_rng(size).integers(32, 127, size).astype(np.uint8)
        pieces = [codes for codes, _ in L.code_runs(data, np.array([0, size]))]
        assert (np.concatenate(pieces) == L.trigram_codes(data)).all()


def test_margins_of_a_long_text_are_those_of_its_trigrams():
    data = np.random.default_rng(5).integers(32, 127, 2 * RUN_BYTES + 9).astype(np.uint8)
    offsets, m = np.array([0, len(data)]), model()
    codes = L.trigram_codes(data)
    own = m.weights[:, codes].sum(axis=1, dtype=np.float64) * (L.SCALE / len(codes)) + m.bias
    assert np.allclose(m.margins(data, offsets)[0], own, rtol=1e-9)
    mean = max(float(row[codes].mean(dtype=np.float64)) for row in m.chance)
    floor = (m.usual - np.log(L.DIMS)) / 2 - L.SLACK * m.spread / np.sqrt(len(codes))
    assert m.learned(data, offsets).tolist() == [mean >= floor]


def test_memory_does_not_grow_with_the_text():
    peaks = []
    for megabytes in (4, 24):
        data = np.full(megabytes << 20, 101, np.uint8)
        m = model()
        tracemalloc.start()
        m.margins(data, np.array([0, len(data)]))
        m.learned(data, np.array([0, len(data)]))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] < 200 << 20
