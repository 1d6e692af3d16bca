import random
import zlib

from rowferry.llm.language_id import ProfileSettings, Profiles, gram_counts, learn_profiles, predict_languages


def plain_counts(text):
    words, counts = "".join(c if c.isalpha() else " " for c in text.lower()).split(), {}
    for word in words:
        marked = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(marked) - n + 1):
                gram = marked[i:i + n]
                if gram != " ":
                    counts[gram] = counts.get(gram, 0) + 1
    return counts


def test_gram_counts():
    for text in ("", "a", "Hello, World! 12", "Été où ß\n\nx", "1234", "中文 abc"):
        grams, counts = gram_counts(text)
        want = {}
        for gram, n in plain_counts(text).items():
            code = 0
            for c in gram:
                code = code << 21 | ord(c)
            want[code] = n
        assert dict(zip(grams.tolist(), counts.tolist())) == want


def test_out_of_place_distance():
    a, b, c = (gram_counts(x)[0][0] for x in "abc")
    profiles = Profiles({"x": [a, b, c], "y": [c, b, a]}, 3)
    assert profiles.predict("a a a b b c")[0] == "x"
    assert profiles.predict(None) == profiles.predict("12 !") == ("und", 0.0)
    assert Profiles({}, 3).predict("abc") == ("und", 0.0)


def test_held_out_accuracy(spark, docs):
    rng = random.Random(1)
    words = {"en": ["the", "and", "thing", "of", "with"], "de": ["der", "und", "nicht", "von", "über"], "fr": ["le", "être", "avec", "dans", "où"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), "s", lang if i % 7 else None)
            for i in range(300) for lang in [("en", "de", "fr")[i % 3]]]
    frame = docs(rows)
    profiles = learn_profiles(frame, ProfileSettings(rows_per_language=40))
    found = {r.doc_id: r for r in predict_languages(frame, profiles).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(found[i].lang_pred == ("en", "de", "fr")[i % 3] for i in held)
    assert all(0 <= r.score <= 1 for r in found.values())
