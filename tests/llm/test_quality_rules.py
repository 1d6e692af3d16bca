import random
import re

from rowferry.llm.quality_rules import LineLimits, apply_quality_rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The base counts, straight from their definitions."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts(docs):
    rng = random.Random(4)
    vocabulary = ["a", "b,", "c#", "dé", "<e>", "f|"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\t", "\x0b", " "]) for _ in range(rng.randint(0, 60)))
             for _ in range(40)] + [None, "", "a b c d e", "a b c d e a b c d e", "x\n\nx\n"]
    found = {r.doc_id: r for r in quality_rules(docs([(i, t) for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        r, want = found[i], plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def body(i, n=14):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_boilerplate_goes_and_copies_stay(docs):
    footer = "Some Footer  of the site number 17 that is everywhere"
    rows = [(i, f"{body(i)}\n{footer.upper() if i % 2 else footer}") for i in range(30)]
    rows += [(100 + i, f"{footer}\n{body('z', 2)}{i}") for i in range(3)]  # hardly more than the footer
    rows += [(200 + i, "\n".join(f"{body(f'c{k}')} {'edit' + str(i) if k == i % 5 else ''}" for k in range(5))) for i in range(40)]
    rows += [(300 + i, f"{body(i)}\n{footer}", "rare host") for i in range(5)]
    found = {r.doc_id: r for r in quality_rules(docs(rows)).collect()}
    assert all(found[i].kept and found[i].n_removed_words == 10 for i in range(30))
    assert not any(found[100 + i].kept for i in range(3))
    # near copies share their lines with their neighbours, so none of them is boilerplate
    assert all(found[200 + i].kept and found[200 + i].n_removed_words == 0 for i in range(40))
    assert all(found[300 + i].n_removed_words == 0 for i in range(5))
    kept = {r.doc_id: r for r in apply_quality_rules(docs(rows)).collect()}
    assert set(kept) == {i for i, r in found.items() if r.kept}
    assert kept[0].text == body(0) and kept[0].n_chars == len(body(0))
    assert kept[200].text == dict((r[0], r[1]) for r in rows)[200]


def test_limits_are_parameters(docs):
    rows = [(i, f"{body(i)}\nshared line of four") for i in range(6)]
    found = quality_rules(docs(rows), LineLimits(max_documents=5)).collect()
    assert all(r.n_removed_words == 4 for r in found)
    assert all(r.n_removed_words == 0 for r in quality_rules(docs(rows), LineLimits(max_documents=6)).collect())


def test_blocks_of_boilerplate_go_as_a_whole(docs):
    footer = [f"footer line {k} of the block" for k in range(6)]
    menu = [f"menu entry {k} here" for k in range(4)]
    rows = [(i, "\n".join([body(i), *footer])) for i in range(300)]
    rows += [(1000 + i, "\n".join([body(f"a{i}"), *menu, body(f"b{i}")]), "other host") for i in range(60)]
    # near copies, edited here and there, stay whole
    rows += [(2000 + i, "\n".join(f"{body(f'c{k}')} {'edit' + str(i) if k == i % 12 else ''}" for k in range(12)), "third host")
             for i in range(60)]
    found = {r.doc_id: r for r in quality_rules(docs(rows)).collect()}
    assert all(found[i].n_removed_words == 36 for i in range(300))
    assert all(found[1000 + i].n_removed_words == 16 and found[1000 + i].kept for i in range(60))
    assert all(found[2000 + i].n_removed_words == 0 and found[2000 + i].kept for i in range(60))
    kept = {r.doc_id: r.text for r in apply_quality_rules(docs(rows)).collect()}
    assert kept[1000] == body("a0") + "\n" + body("b0")


def test_a_share_of_the_host_counts_too(docs):
    rows = [(i, f"{body(i)}\nshared line of four" if i < 8 else body(i)) for i in range(100)]
    limits = {"max_documents": 5}
    assert sum(r.n_removed_words for r in quality_rules(docs(rows), LineLimits(**limits)).collect()) == 32
    assert sum(r.n_removed_words for r in quality_rules(docs(rows), LineLimits(max_per_mille=80, **limits)).collect()) == 0
