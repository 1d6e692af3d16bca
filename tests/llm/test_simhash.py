import random
import re

import pytest
import xxhash
from pyspark.sql import types as T

from rowferry.llm.components import components
from rowferry.llm.simhash import SimHashSettings, fingerprint, keep_one, links, simhash_groups


def plain(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Ab", "cÉ", "x\x0by", "z z", "d\n"]) for _ in range(n)) for n in range(40)] + [None, "", "one"]
    for text in texts:
        assert fingerprint(text, 3, 42) & (1 << 64) - 1 == plain(text)


def least_reachable(values, distance):
    label = dict.fromkeys(values)
    for v in values:
        label[v] = v
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("settings", [SimHashSettings(), SimHashSettings(bucket=1), SimHashSettings(segments=4), SimHashSettings(segments=3)])
def test_links_connect_what_is_near(spark, settings):
    rng, values = random.Random(7), set()
    for _ in range(12):
        v = rng.getrandbits(64)
        for _ in range(8):
            values.add(v)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                v ^= 1 << b
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], T.StructType([T.StructField("fp", T.LongType())]))
    found = links(frame, settings)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in found.collect())
    labels = {r.node: r.label for r in components(found).collect()}
    want = least_reachable([v & (1 << 64) - 1 for v in signed], 2)
    groups, wanted = {}, {}
    for v in signed:
        groups.setdefault(labels.get(v, v), set()).add(v)
        wanted.setdefault(want[v & (1 << 64) - 1], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_groups_and_the_one_kept(docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(rng.choice(words) for _ in range(3000))
    rows = [(5, base), (3, base + " end"), (9, base.upper()), (1, "something else"), (1, "something else"), (2, ""), (4, None)]
    found = {(r.doc_id, r.component_id) for r in simhash_groups(docs(rows)).collect()}
    assert found == {(5, 3), (3, 3), (9, 3), (1, 1), (2, 2), (4, 2)}
    assert sorted(r.doc_id for r in keep_one(docs(rows)).collect()) == [1, 2, 3]
