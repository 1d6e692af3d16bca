import random
import re
import string

from rowferry.llm.secret_scan import listed, redact_secrets, secret_scan

NAMES = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans(docs):
    rng = random.Random(2)
    pieces = ["password", "PassWd", "API_KEY", "apikey", "token", "secret", ":", "=", " ", "'", '"', "abcdefgh", "short", "AKIA",
              "AKIA1234567890AB", "0123456789abcdef" * 2, "deadbeef", "é", "\U0001f600", "\n", "-", ".", "Z"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "secret: token: abcdefgh12", "password=abcdefgh" * 50]
    rows = secret_scan(docs(list(enumerate(texts)))).select("doc_id", listed("base").alias("base"))
    found = {r.doc_id: r.base for r in rows.collect()}
    assert [found[i] for i in range(len(texts))] == [plain(t) for t in texts]


def test_battery_tells_random_tokens_from_names(docs):
    rng, texts, kinds = random.Random(5), [], []
    for i in range(400):
        n = rng.choice([24, 32, 40])
        if i % 2:
            token = "".join(rng.choice(string.ascii_lowercase + string.digits) for _ in range(n))
        else:
            token = "-".join(rng.choice(["page", "index", "chapter2", "section", "2024", "archive", "part1"]) for _ in range(6))
        kinds.append(i % 2)
        texts.append(f"see {token} here")
    found = {r.doc_id: len(r.spans) for r in secret_scan(docs(list(enumerate(texts)))).collect()}
    assert sum(found[i] for i in range(400) if kinds[i]) > 180
    assert sum(found[i] for i in range(400) if not kinds[i]) < 10


def test_redaction(docs):
    rows = [(1, "a password=abcdefgh1 b"), (2, "token = 0123456789abcdef0123456789abcdef0 c"), (3, "plain"), (4, None)]
    found = {r.doc_id: (r.text, r.n_chars) for r in redact_secrets(docs(rows)).collect()}
    assert found == {1: ("a [assign] b", 12), 2: ("[assign] c", 10), 3: ("plain", 5), 4: (None, None)}


def test_letters_and_keys_after_paths_are_tested(docs):
    rng, texts, want = random.Random(6), [], []
    kinds = [("", string.ascii_lowercase), ("", string.ascii_uppercase), ("", string.ascii_letters),
             ("com/v1/", string.ascii_letters + string.digits + "-_")]
    for i in range(800):
        before, alphabet = kinds[i % 4]
        token = "".join(rng.choice(alphabet) for _ in range(40))
        texts.append(f"see {before}{token} here")
        want.append((4 + len(before), 44 + len(before)))
    found = {r.doc_id: [(x.start, x.end) for x in r.spans] for r in secret_scan(docs(list(enumerate(texts)))).collect()}
    for kind in range(4):
        hits = sum(any(a <= want[i][0] and want[i][1] <= b for a, b in found[i]) for i in range(kind, 800, 4))
        assert hits > 160, (kinds[kind], hits)


def test_few_tokens_of_a_table_are_found(docs):
    """A table's only random token, or its only five, each kind and length a table of its own."""
    rng = random.Random(8)
    kinds = [(string.ascii_lowercase + string.digits, 40), (string.ascii_letters + string.digits, 32),
             (string.ascii_letters + string.digits + "+/", 44), (string.ascii_uppercase + string.digits, 24)]
    found = tokens = 0
    for alphabet, size in kinds:
        for many in (1, 5):
            texts = [f"see {''.join(rng.choice(alphabet) for _ in range(size))} in some words" for _ in range(many)]
            rows = secret_scan(docs(list(enumerate(texts)))).collect()
            found += sum(any(x.start == 4 and x.end == 4 + size for x in r.spans) for r in rows)
            tokens += many
    assert found >= 0.8 * tokens
    names = ["see home/page-index-of-the-archive/section-and-chapter here", "see this_is_a_long_variable_name_of_a_program here",
             "see zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz here", "see 11111111112222222222 here"]
    for name in names:
        assert all(not r.spans for r in secret_scan(docs([(1, name)])).collect()), name
