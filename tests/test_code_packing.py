import numpy as np

from quarry.functions import codes


def test_codes_are_packed_by_the_word_and_by_the_bit(monkeypatch):
    rng = np.random.default_rng(5)
    ids = np.concatenate([np.sort(rng.integers(0, 2**e, n)) for e, n in ((1, 9), (4, 700), (20, 900), (41, 400), (44, 1))])
    starts = np.array([0, 1, 9, 9 + 700, 9 + 700 + 333, 9 + 700 + 900, len(ids) - 1])
    words = codes.pack(ids, starts)
    done = []
    monkeypatch.setattr(codes, "_pack_words", lambda *a: done.append(1))
    codes.pack(ids, starts)
    assert done                          # was bit by bit, whatever the ids
    monkeypatch.setattr(codes, "_WINDOW", 0)
    for a, b in zip(words, codes.pack(ids, starts)):
        assert a.dtype == b.dtype and np.array_equal(a, b)
    wide = np.array([0, 0, 2**53 - 1, 2**53, 2**62, 2**63 - 1])
    data, first, _ = codes.pack(wide, np.array([0]))
    assert codes.unpack(data.tobytes(), 6, 2)[0] == wide.tolist()
