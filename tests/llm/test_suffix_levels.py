import collections
import hashlib
import random

import numpy as np
import pytest

from rowferry.llm.suffix_levels import RepeatSettings, SuffixLevels, landmarks, remove_repeats


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        starts = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, x in zip(d, gone[1:-1]) if not x)
        out.append((len(d), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages, texts = [prose(60) for _ in range(3)], []
    for i in range(60):
        text = prose(rng.randint(5, 120))
        if i % 3 == 0:
            text += passages[i % 2] + prose(rng.randint(0, 30))
        if i % 7 == 0:
            text = passages[2][rng.randint(0, 40):] + text
        if i % 11 == 0:
            text = "ab" * 400
        if i % 13 == 0:
            text += "x" * rng.randint(190, 420)
        texts.append(text)
    base = texts[20] * 3
    for _ in range(8):
        at = rng.randint(0, len(base) - 5)
        texts.append(base[:at] + "#" + base[at + 1:])
    return texts + [texts[4], texts[5], "", None, "short"]


@pytest.mark.parametrize("settings", [RepeatSettings(), RepeatSettings(group=2, batches=2), RepeatSettings(length=120, batches=1)])
def test_against_brute_force(docs, settings):
    texts = corpus()
    found = sorted(remove_repeats(docs(list(enumerate(texts))), settings).collect())
    assert [tuple(r)[1:] for r in found] == plain(texts, settings.length)


def test_landmarks_of_slices(monkeypatch):
    """A text cut into slices has the same passages, each once."""
    monkeypatch.setattr("rowferry.llm.suffix_levels.SLICE", 1000)
    data = random.Random(1).randbytes(5321)
    _, _, places, first, last = landmarks(data, 200)
    assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
    assert ((places >= last) & (places <= first + 160)).all()


def test_levels_merge_geometrically(spark, docs):
    index = SuffixLevels(spark, 200)
    for batch in range(5):
        index.add(docs([(batch, random.Random(batch).randbytes(600).hex())]).select("text"))
    assert [rank for rank, _ in index.levels] == [2, 0]
