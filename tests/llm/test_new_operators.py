"""Substrings, tokenizer alignment, spelling variants and predictions against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from snapledger.llm import alignment, language, substrings, variants

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def prose(seed, n, words=300):
    return " ".join(f"w{k}" for k in np.random.default_rng(seed).integers(0, words, n))


def removed(docs):
    """By the rule: ids in order, null ones last and equal ones not earlier than one another."""
    rank = [float("inf") if d is None else d for d, _ in docs]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    least, out = {}, []
    for r, w in zip(rank, words):
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            least[key] = min(least.get(key, float("inf")), r)
    for (d, _), r, w in zip(docs, rank, words):
        seen, gone = set(), set()
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            if least[key] < r or key in seen:
                gone |= set(range(i, i + 20))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PASSAGE, OTHER = prose(1, 60), prose(2, 45)
REPEATS = [
    (5, PASSAGE), (3, f"{prose(3, 30)} {PASSAGE} {prose(4, 30)}"), (9, f"{prose(5, 7)} {PASSAGE}\n{OTHER} end"), (7, OTHER + "\t\n"),
    (8, " ".join(PASSAGE.split()[10:45])), (6, " ".join(PASSAGE.split()[:19])), (4, f"{OTHER} {OTHER} {OTHER}"), (11, None), (12, ""), (13, "   "),
    (14, "x " * 100), (15, prose(6, 20)), (16, prose(6, 20)), (17, prose(6, 20) + " "), (2, prose(7, 4000)), (18, " ".join(prose(7, 4000).split()[1000:1500])),
    (20, "é ç " * 30), (21, "é ç " * 12), (22, PASSAGE.replace("w1", "W1")), (None, PASSAGE), (None, PASSAGE), (23, PASSAGE), (23, PASSAGE + " more"), (23, PASSAGE),
    *[(100 + k, f"{prose(50 + k, 3 + k % 5)} {OTHER} {prose(90 + k, 4)}") for k in range(40)],
]


@pytest.mark.parametrize("size", [1 << 20, 2000])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(substrings, "BLOCK", size)
    docs = spark.createDataFrame(REPEATS, "doc_id long, text string").repartition(3)
    got = substrings.remove_repeats(docs).collect()
    digest = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got]
    assert sorted(digest, key=repr) == sorted(removed(REPEATS), key=repr)
    spans = {r.doc_id: [(s.start, s.end, s.source) for s in r.spans] for r in got}
    assert spans[3] == [] and spans[5] == [(0, 60, 3)] and spans[8] == [(0, 35, 3)] and spans[4] == [(45, 90, 4), (90, 135, 4)] or spans[4][0][2] == 4
    for r in got:
        covered = {i for s in r.spans for i in range(s.start, s.end)}
        assert len(covered) == r.n_removed and all(s.end - s.start >= 20 for s in r.spans)


def test_repeats_in_random_documents_of_few_words(spark, monkeypatch):
    """Few words, so that anchors stand in many phrases and most passages end within one."""
    monkeypatch.setattr(substrings, "BLOCK", 3000)
    rnd = np.random.default_rng(11)
    parts = [prose(200 + k, int(rnd.integers(5, 70)), 3) for k in range(25)]
    docs = [(int(k), " ".join(parts[j] for j in rnd.integers(0, 25, int(rnd.integers(1, 6))))) for k in rnd.permutation(120)]
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(got) == sorted(removed(docs)) and sum(r[2] for r in got) > 1000


def aligned(docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b, alphabet = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), alignment.byte_alphabet()
    a.encode_special_tokens = True
    found, counts = [], Counter()
    for d, text in docs:
        groups, want = [], f" {text}".encode()
        x, y = a.encode(f" {text}", add_special_tokens=False), b.encode(text or "")
        xs = [bytes(alphabet[c] for c in t) for t in x.tokens]
        ys = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
        if text and b"".join(xs) == want and b"".join(ys) == want:
            x_end, y_end = np.cumsum([len(t) for t in xs]).tolist(), np.cumsum([len(t) for t in ys]).tolist()
            i = j = 0
            for cut in sorted({*x_end} & {*y_end}):
                groups.append((x.ids[i:x_end.index(cut) + 1], y[j:y_end.index(cut) + 1]))
                i, j = x_end.index(cut) + 1, y_end.index(cut) + 1
        links = [(p, q) for g, h in groups for p in g for q in h]
        counts.update(set(links))
        found.append((d, groups, links))
    top = Counter()
    for (p, _), n in counts.items():
        top[p] = max(top[p], n)
    out = []
    for d, groups, links in found:
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((d, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links), sum(counts[k] == top[k[0]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


ODD = ["", None, " ", "  ", "a", " a b", "x\r\ny\r z", "foo();\r\nbar", "tab\tsep\t\tx", "\n\nline\n", "ends  ", "ends\n", "<|endoftext|> and <s> </s> <unk>", "has ▁ sign", "▁",
       "a b c　 d   e", "日本語テキスト 混ざる", "emoji 😀😀 x", "\x00\x01 z", "ﬁ é é ½", "a" * 500, " " * 300 + "x", "ab " * 1000, "don't we'll I'm 'S",
       "12345 67,890.12", "\u0085 x y", "mixed\t \n x", "Ωμέγα слово مرحبا", "x\x0by\x0cz", "{\r\n}\r\n  ;\r"]


@pytest.mark.parametrize("most", [1 << 18, 8])
def test_alignment_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_SEGMENTS", most)
    docs = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, prose(k, 40, 30)) for k in range(20)] + [(None, "no id"), (4, "a"), (4, "a")]
    own = alignment.Aligner(A, B)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    if most == 8:  # a table of segments that begins anew all the time
        import pyarrow as pa
        for text in ("one two three four five six", "seven eight nine ten one two", "one two"):
            number, counts = own.segments(pa.array([f" {text}"]))
            assert counts.tolist() == [len(text.split())] and own.good[number].all()
        return
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in alignment.align(table.repartition(3), A, B).collect()]
    assert sorted(got, key=repr) == sorted(aligned(docs), key=repr)
    clash = table.selectExpr("*", "1 as block", "'x' as a", "2 as n_a", "3 as docs")
    assert sorted(map(tuple, alignment.align(clash, A, B).collect()), key=repr) == sorted(got_in_order(alignment.align(table, A, B)), key=repr)
    assert alignment.align(table.limit(0), A, B).count() == 0


def got_in_order(df):
    return list(map(tuple, df.collect()))


def spelled(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            check = zlib.crc32(f"{d}:{run}".encode())
            if check % 199 == 0:
                run = run[:check % len(run)] + run[check % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, rows = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
        rows[w] = len(others)
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], rows[w], n.get(form[w])))
    return out


SHARES = np.array([30, 3, 1, 1, 5, 1, 9, 2, 1, 40, 4, 0.5, 6, 1, 8, 1, 1])


def test_spelling_variants_equal_brute_force(spark):
    rnd = np.random.default_rng(4)
    base = ["abcdef", "abcdeg", "abcdefg", "xabcdef", "abdcef", "bcdefgh", "Größen", "größe", "grössen", "aaaaaa", "aaaaaaa", "aaaaaaaa", "naïveté", "naiveté", "wordlong", "wordlongs", "ÀÉÎÕÜß"]
    docs = [(None if k == 7 else k % 150, " ".join(rnd.choice(base, 12, p=SHARES / SHARES.sum()))
             + rnd.choice([" ", "-", "1", ""]) + rnd.choice(["ABCDEF", "abcdefz", "x", "÷×÷×÷×"])) for k in range(200)] + [(0, None), (1, "")]
    got = [tuple(r) for r in variants.group_variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(spelled(docs), key=repr)
    assert len({r[2] for r in got}) < len(got) - 3 and any(r[1] and r[1] != r[2] for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n string, key int")
    assert variants.group_variants(empty).count() == 0


def test_every_pair_one_edit_apart_meets(spark):
    """All single edits of words of several lengths, at every place."""
    words = ["abcdef", "abcdefg", "abcdefgh", "abcdefghijk"]
    edits = {w[:i] + c + w[j:] for w in words for i in range(len(w) + 1) for j in (i, i + 1) for c in ("", "z")} - {""}
    table = spark.createDataFrame([(w, 9) for w in sorted({w for w in edits | {*words} if len(w) >= 6})], "word string, n long")
    every = [r.word for r in table.collect()]
    got = {(r.x, r.y) for r in variants.near_pairs(table).collect()}
    assert all((min((a, b), key=lambda v: (len(v), v)), max((a, b), key=lambda v: (len(v), v))) in got for a in words for b in every if one_edit(a, b))
    assert all(one_edit(a, b) for a, b in got) and len(got) == len({frozenset(p) for p in got})


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_languages_by_brute_force(spark):
    texts = {"en": "the cat and the dog of this house", "fr": "le chat et le chien de cette maison", "de": "die katze und der hund von diesem haus"}
    docs = [(k, " ".join(np.random.default_rng(k).permutation(texts[lang].split())), lang) for k, lang in enumerate(["en", "fr", "de"] * 20)]
    odd = [(900, "½ ²", "en"), (901, "①", "de"), (902, "12 34 _", "fr"), (903, None, "fr"), (904, "", "fr"), (905, "é", None)]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(table).collect()}
    assert [got[k].lang_pred for k in range(900, 905)] == ["und"] * 5 and got[905].lang_pred != "und"
    taught = [(t, lang) for d, t, lang in docs + odd if t is not None and lang and zlib.crc32(str(d).encode()) % 4 != 2]
    langs = sorted(set(texts))

    def buckets(text):
        out = Counter()
        _, orders = language.grams([text])
        for b, valid in orders:
            out.update(b[valid].tolist())
        return out

    total = {lang: Counter() for lang in langs}
    for t, lang in taught:
        total[lang].update(buckets(t))
    size = {lang: sum(total[lang].values()) + 0.5 * language.BUCKETS for lang in langs}
    for d, t, _ in docs:
        own = buckets(t)
        odds = np.array([sum(n * np.log((total[lang][b] + 0.5) / size[lang]) for b, n in own.items()) for lang in langs])
        assert got[d].lang_pred == langs[int(odds.argmax())]
        assert abs(got[d].score - 1 / np.exp(odds - odds.max()).sum()) < 1e-3
    assert sum(got[d].lang_pred == lang for d, _, lang in docs) >= 58
    column = table.select("doc_id", language.predicted(table).alias("f")).collect()
    assert {r.doc_id: (r.f.lang_pred, r.f.score) for r in column} == {k: (r.lang_pred, r.score) for k, r in got.items()}


def test_scores_do_not_depend_on_the_piece_size(monkeypatch):
    matrix = np.random.default_rng(1).normal(size=(language.BUCKETS, 5)).astype(np.float32)
    texts = [prose(k, 30) for k in range(7)] + ["x", ""]
    whole = language.score(texts, matrix)
    monkeypatch.setattr(language, "GATHERED", 64)
    assert np.allclose(language.score(texts, matrix), whole, atol=1e-3)


def plain_base(text, kinds):
    """The base spans by one search after another, as the contract words them."""
    found = []
    for kind, pattern, good in kinds:
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if good(m)]
    order = [k for k, _, _ in kinds]
    return [f"{k}:{s}:{e}" for k, s, e in sorted(found, key=lambda x: (x[1], order.index(x[0])))]


def digits(m):
    return [int(c) for c in m[0] if c.isdigit()]


def luhn(m):
    d = digits(m)
    return 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0


SECRETS = [
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]
PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]
PIECES = ["password", "PassWord", "api_key", "apikey", "token", "secret", "=", " = ", ":", "'", '"', "AKIA", "ABCD1234EFGH5678", "0123456789abcdef0123456789abcdef", "deadbeef", " ", "\n",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "a.b%c@d-e.f", "@x.y", "me@host", "+49 (30) 123456-78", "+1 2", ".", "-", "é", "😀", "hunter2hunter2", "+"]


@pytest.mark.parametrize("module,kinds", [("secret_scan", SECRETS), ("pii", PERSONAL)])
def test_base_spans_equal_plain_searches(module, kinds):
    import importlib

    scan = importlib.import_module(f"snapledger.llm.{module}")
    rnd = np.random.default_rng(9)
    for _ in range(3000):
        text = "".join(rnd.choice(PIECES, int(rnd.integers(1, 14))))
        found = [f"{k}:{s}:{e}" for k, s, e, _ in scan.scan_text(text) if k in scan.BASE_KINDS]
        assert found == plain_base(text, kinds), text


LONG = {
    "chain of signs": "x=" * 500_000, "colons": "a:" * 500_000, "sensitive chain": "password=" * 100_000, "sum": "x=" * 20_000 + "+".join(["y"] * 20_000),
    "constants": "x0 = 'a'\n" + "".join(f"x{k + 1} = x{k} + \"b{k}\"\n" for k in range(20_000)) + "password = x20000\n",
    "one constant often": "k = 'hunter2hunter2'\n" + "".join(f"password{k} = k\n" for k in range(20_000)),
    "findings": "".join(f"u{k}@host{k}.example.org 555-123-{k % 9000 + 1000} phone\n" for k in range(20_000)), "quotes": "x=\"" * 200_000, "spaces": " " * 1_000_000 + "password=abcdefgh1234",
    "indented lines": (" " * 2000 + "a=b c=d e=f\n") * 300,
}


@pytest.mark.parametrize("name", LONG)
def test_no_text_takes_the_square_of_its_length(name):
    import time

    from snapledger.llm import pii, secret_scan

    start = time.time()
    secret_scan.scan_text(LONG[name])
    pii.scan_text(LONG[name])
    assert time.time() - start < 30


def literals(text):
    from snapledger.llm import secret_scan

    return [text[s:e] for k, s, e, _ in secret_scan.scan_text(text) if k == "literal"]


def test_literals_by_name_and_place():
    for indent in (0, 79, 81, 5000):
        assert literals(" " * indent + "password=p@ss#w0rd1!\n") == ["p@ss#w0rd1!"]
    for name in ("DBPassword", "dbpassword", "MYPASS", "passwords", "tokens", "client_secret", "userToken"):
        assert literals(f"{name} = 'h7Xq93kLmP2z'") == ["h7Xq93kLmP2z"], name
    assert literals("compass = 'h7Xq93kLmP2z'; monkey = 'h7Xq93kLmP2z'") == []
    assert literals("<password>h7Xq93kLmP2z</password><name>h7Xq93kLmP2z</name>") == ["h7Xq93kLmP2z"]
    assert literals("a = 'h7Xq93'\nb = a + 'kLmP2z'\npassword = b") == ["h7Xq93", "kLmP2z"]
    assert literals("a = 'xxxxxxxxxxxx'\npassword = a\ntoken = '${VALUE_OF_IT}'\nsecret = 'your_password_goes_here'") == []
    assert literals("token=" + "x" * 200) == [] and literals("opt=password=hunter2hunter2") == ["hunter2hunter2"]


def test_queries_return_scores(spark):
    from snapledger.llm import pii, queries, secret_scan

    docs = spark.createDataFrame([(1, "call me: a@b.example now, mail c@d.example; password = 'hunter2hunter2'"), (2, None)], "doc_id long, text string")
    for scan, module in ((pii.find_pii, pii), (secret_scan.find_secrets, secret_scan)):
        rows = {r.doc_id: r for r in queries._span_digest(scan(docs), module.BASE_KINDS, module.KINDS).collect()}
        assert len(rows[1].scores.split(",")) == len(rows[1].spans.split(",")) and rows[2].scores == rows[2].spans == ""
    found = {r.doc_id: r.found for r in pii.find_pii(docs).collect()}
    assert [x.score for x in found[1]] == [1.0, 1.0] or found[1][0].score <= found[1][1].score


def test_substrings_ignore_other_columns_and_take_an_empty_table(spark):
    docs = spark.createDataFrame(REPEATS[:12], "doc_id long, text string")
    clash = docs.selectExpr("*", "1 as block", "'x' as texts", "2 as n_words", "'y' as kept", "3 as anchor", "4 as window")
    assert sorted(map(str, substrings.remove_repeats(clash).collect())) == sorted(map(str, substrings.remove_repeats(docs).collect()))
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
