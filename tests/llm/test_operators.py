"""The training-data operators and the pipeline on small tables with nulls, empty and long texts, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from snapledger.llm import embeddings, fingerprint, language, license_scan, minhash, mixing, packing, pii, secret_scan, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{k}" for k in range(400)]


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def rows():
    base = prose(1, 200)
    near = base.split()
    near[100] = "changed"
    texts = [
        base, " ".join(near), base, prose(2, 120), prose(3, 6000), "", None, "   ", "two words", "1234 5678",
        "contact anna@example.org now. password = 'hunter2hunter2'", "MIT License. " + prose(4, 60), prose(5, 90),
    ]
    out = [(k, t, "en" if k % 3 else "de", ["a", "b", None][k % 3], len(t or "")) for k, t in enumerate(texts)]
    return [*out, out[3], (None, prose(6, 80), None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k % 4 == 1)) for k in range(13)] + [(None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


CALLS = {
    "secrets": lambda d, _: secret_scan.find_secrets(d),
    "licences": lambda d, _: license_scan.find_licences(d),
    "near": lambda d, _: minhash.link_documents(d),
    "fingerprints": lambda d, _: fingerprint.fingerprint_documents(d),
    "mix": mixing.mix,
    "pii": lambda d, _: pii.find_pii(d),
    "language": lambda d, _: language.identify(d),
    "toxicity": toxicity.score_toxicity,
}


@pytest.mark.parametrize("name", CALLS)
def test_each_row_is_answered_once_whatever_it_holds(spark, docs, labels, name):
    """Nulls, empty and long texts, repeats; columns named like results change nothing; an empty table gives no rows."""
    call = CALLS[name]
    ids = sorted(str(r[0]) for r in rows())
    got = call(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ids
    clash = docs.selectExpr("*", "'x' as score", "1 as size", "'y' as found", "2 as class", "3 as component_id", "'z' as lang_pred")
    assert sorted(map(str, call(clash, labels).collect())) == sorted(map(str, got))
    assert call(docs.limit(0), labels).collect() == []


def shingles(text, width):
    words = re.findall(r"[^ \t-\r]+", (text or "").lower())
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def test_near_duplicates_equal_brute_force(spark):
    base = [prose(k, 60) for k in range(6)]
    texts = []
    for k, text in enumerate(base):
        words = text.split()
        texts.append(text)
        for step in range(k + 1):  # chains of edits, so that some links reach further than one step
            words[(step * 13) % 60] = f"e{step}"
            texts.append(" ".join(words))
    texts += ["", None, "one", "one", "ONE"]
    sets = [shingles(t, 4) for t in texts]
    parent = list(range(len(texts)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    got = minhash.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {k: (len(sets[k]), top(k), top(k) == k) for k in range(len(texts))}


def test_fingerprints_of_edited_texts(docs):
    got = {r["doc_id"]: r for r in fingerprint.fingerprint_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    texts = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    for k, text in texts.items():
        following = texts[k - 1 if k else max(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert (got[k]["n_chars"], got[k]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[k]["near_edited"] <= 1 and 0 <= got[k]["near_next"] <= 1
    assert got[0]["fingerprint"] == got[2]["fingerprint"] != got[1]["fingerprint"]
    assert got[1]["near_next"] > 0.5 > got[4]["near_next"]


def test_equal_substrings_share_phrases_at_any_offset():
    shared = prose(7, 800)
    _, owner, hashed = fingerprint.phrases([shared, "some other start, " + shared, prose(8, 800)])
    sets = [set(hashed[owner == k].tolist()) for k in range(3)]
    assert len(sets[0] & sets[1]) > 0.9 * len(sets[0]) and len(sets[0] & sets[2]) < 0.2 * len(sets[0])


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    vectors = [(c + rng.standard_normal(16) * 0.05 * (k % 3)).tolist() for k, c in enumerate(np.repeat(centres, 20, axis=0))]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e-300] * 16]
    data = [(k, v) for k, v in enumerate(vectors + odd)] + [(None, [5.0, 1.0])]
    got = {r["vec_id"]: r for r in embeddings.link_embeddings(spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as class", "2 as name")).collect()}
    m = np.array(vectors)
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    want, have = near.sum(), sum(got[k]["n_links"] for k in range(len(vectors)))
    assert 0.98 * want <= have <= want
    assert all(got[k]["n_links"] <= near[k].sum() for k in range(len(vectors)))
    first = len(vectors)
    assert [(got[k]["n_links"], got[k]["component_id"] - first) for k in range(first, first + 10)] == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (1, 6), (1, 6), (1, 8), (1, 8)]
    assert (got[None]["n_links"], got[None]["component_id"]) == (0, None)
    assert embeddings.link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []


def test_lattice_points_are_nearest():
    x = np.random.default_rng(0).normal(size=(200, 8)) * 2
    point = embeddings.decode(x)
    for move in embeddings.MINIMAL:
        assert (((x - point) ** 2).sum(axis=1) <= ((x - point - move) ** 2).sum(axis=1) + 1e-9).all()


def test_mix_meets_targets_and_agrees_on_reruns(docs, labels):
    got = mixing.mix(docs, labels).collect()
    again = mixing.mix(docs.repartition(5), labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    sources = {}
    for r in got:
        sources.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(taken) - target) <= 1 for (_, target), taken in sources.items())


def test_packing_keeps_each_id_once(spark, docs):
    from tokenizers import Tokenizer
    import zlib

    encode = Tokenizer.from_file(tokenizer()).encode
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    pieces = packing.pack(some, tokenizer()).collect()
    for r in some.collect():
        ids = np.array([*encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((p for p in pieces if p["doc_id"] == r["doc_id"]), key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == len(ids) == own[0]["doc_tokens"]
        at = 0
        for p in own:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
    for s in {p["sequence_id"] for p in pieces}:
        at = 0
        for p in sorted((p for p in pieces if p["sequence_id"] == s), key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    assert packing.pack(docs.limit(0), tokenizer()).collect() == []


def test_pipeline_stages(spark, docs, labels, tmp_path):
    """Each stage on all that the one before kept; texts without letters, near copies and repeats go, clean ones stay."""
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.language_id(spark, docs, str(tmp_path))
    assert tuple(found.columns) == corpus_pipeline.COLUMNS
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(r[0]) for r in rows() if re.search("[a-z]", r[1] or ""))
    one = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    kept = [r["doc_id"] for r in one.collect()]
    assert tuple(one.columns) == corpus_pipeline.COLUMNS
    assert sorted(k for k in kept if k is not None) == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    masked = {r["doc_id"]: r for r in corpus_pipeline.personal_data(spark, docs, str(tmp_path)).where("doc_id is not null").collect()}
    assert "anna@" not in masked[10]["text"] and "[EMAIL]" in masked[10]["text"] and masked[6]["text"] is None
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    taken = sum(r["taken"] for r in mixing.mix(docs, labels).collect())
    assert sum(len(re.findall(r"[^ \t-\r]+", r["text"])) for r in mixed.collect()) == taken
    assert tuple(mixed.columns) == corpus_pipeline.COLUMNS
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_pipeline_of_an_empty_table(spark, docs, labels, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def toxic_by_phrases(spark, phrase, noise):
    """Scores of unlabelled texts with and without phrases that stand once in a counted and once in a fitted toxic text."""
    parts = {k: [d for d in range(4000) if zlib.crc32(str(d).encode()) % 5 == k] for k in (0, 1, 4)}
    texts, known = [], []
    for k in range(40):
        for part in (1, 4):
            texts += [(parts[part][2 * k], f"{noise(k, part, 1)} {phrase(k, True)}"), (parts[part][2 * k + 1], f"{noise(k, part, 0)} {phrase(k, False)}")]
            known += [(parts[part][2 * k], 1), (parts[part][2 * k + 1], 0)]
        texts += [(parts[0][2 * k], phrase(k, True)), (parts[0][2 * k + 1], phrase(k, False))]
    found = toxicity.score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in found.collect()}
    return [got[parts[0][2 * k]] for k in range(40)], [got[parts[0][2 * k + 1]] for k in range(40)]


def letters(seed, n, alphabet="abcdefghijklmnopqrstuvwxyz"):
    return "".join(np.random.default_rng(seed).choice(list(alphabet), n))


def test_toxic_phrases_seen_once_count_however_large_the_corpus(spark):
    toxic, plain = toxic_by_phrases(spark, lambda k, bad: letters([k, bad], 60), lambda k, part, bad: letters([k, part, bad, 7], 8000))
    assert sum(a > 0.5 > b for a, b in zip(toxic, plain, strict=True)) >= 38


def test_toxicity_odds_equal_brute_force(spark, monkeypatch):
    texts = [(prose(k, 12) + "!" * (k % 3), [1, 0, None][k % 3]) for k in range(30)]
    table = spark.createDataFrame(texts, "text string, toxic int")
    found = [toxicity.learn(table)]
    monkeypatch.setattr(toxicity, "PARTS", 7)
    found.append(toxicity.learn(table.repartition(3)))
    assert len(found[0][0]) == len(found[1][0]) > 300
    grams = [(t[k:k + 6], c) for text, c in texts for t in [f" {text} "] for k in range(len(t) - 5)]
    fives = {g[1:] for g, _ in grams}
    n = {c: Counter(g for g, kind in grams if kind == c) for c in (1, 0)}
    ways = {c: Counter(g[1:] for g in n[c]) for c in (1, 0)}

    def shared(four):
        return (sum(f[1:] == four for f in fives) + 0.1) / (sum(f[1:4] == four[:3] for f in fives) + 6.4)

    def back(counts, g, lower):
        beside = [v for k, v in counts.items() if k[:-1] == g[:-1]]
        return lower if not beside else (max(counts[g] - 0.75, 0) + 0.75 * len(beside) * lower) / sum(beside)

    text = " " + prose(3, 6) + " unseen w1 " + prose(99, 4) + " "
    want = []
    for g in (text[k:k + 6] for k in range(len(text) - 5)):
        toxic, plain = (back(n[c], g, back(ways[c], g[1:], shared(g[2:]))) for c in (1, 0))
        want.append(np.log(toxic / plain))
    codes, inside, _ = toxicity.sequences([text[1:-1]])
    for model in found:
        assert np.allclose(toxicity.Model(*model).odds(codes)[inside], want, atol=1e-5)


def test_toxic_phrases_are_found_in_any_script(spark):
    cyrillic = "абвгдежзийклмнопрстуфхцчшщыэюя"
    toxic, plain = toxic_by_phrases(spark, lambda k, bad: letters([5, k % 4, bad], 60, cyrillic), lambda k, part, bad: letters([k, part, bad], 50, cyrillic))
    assert sum(a > 0.5 > b for a, b in zip(toxic, plain, strict=True)) == 40


def test_a_file_of_all_notices_gets_all_labels(spark):
    notices = [text for _, text, _ in license_scan.TEMPLATES]
    texts = [*notices, "\n\n".join([prose(1, 50), *notices, prose(2, 50)])]
    found = {r["doc_id"]: r for r in license_scan.find_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    whole = found.pop(len(notices))
    assert set(whole["labels"].split(",")) == {label for r in found.values() for label in r["labels"].split(",")} == {t[0] for t in license_scan.TEMPLATES}
    assert whole["score"] == 1.0


def test_packing_keeps_all_three_limits(spark):
    table = spark.createDataFrame([(k, prose(k, 5 + 37 * k % 90), 11 * k % 40) for k in range(120)], "doc_id long, text string, unmasked long")
    pieces = packing.pack(table.repartition(2), tokenizer(), unmasked_col="unmasked", size=128, segments=3, loss=50).collect()
    first, inside, total = {k: 11 * k % 40 for k in range(120)}, {}, {}
    for p in pieces:
        bearing = max(0, p["start"] + p["length"] - max(p["start"], first[p["doc_id"]]))
        inside.setdefault(p["sequence_id"], []).append((p["length"], 1, bearing))
        total.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["doc_tokens"]))
    used = [tuple(map(sum, zip(*x, strict=True))) for x in inside.values()]
    assert all(t <= 128 and s <= 3 and b <= 50 for t, s, b in used)
    assert any(s == 3 for _, s, _ in used) and any(b == 50 for _, _, b in used)
    for found in total.values():
        at = 0
        for start, length, whole in sorted(found):
            assert start == at
            at += length
        assert at == whole
    assert len(total) == 120


def test_workers_keep_no_encoder_after_packing(spark):
    docs = spark.createDataFrame([(k, f"some text {k}") for k in range(40)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs, tokenizer()).count() >= 40

    def kept(batches):
        import gc
        for batch in batches:
            held = sum(type(x).__name__ == "Encoder" and x.tokenizer is not None for x in gc.get_objects())
            yield pa.record_batch([pa.array([held] * batch.num_rows, pa.int64())], ["held"])

    assert {r.held for r in spark.range(0, 64, 1, 8).mapInArrow(kept, "held long").collect()} == {0}


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " x  <|endoftext|>\n\ny <|endoftext|> z", "<|endoftext|>"])
def test_special_tokens_in_a_text_are_one_id(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    ids, counts = tokens.Encoder(tokenizer()).encode(pa.array([text, "plain words", text]))
    want = [whole.encode(t, add_special_tokens=False).ids for t in (text, "plain words", text)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert whole.token_to_id("<|endoftext|>") in want[0]


@pytest.mark.parametrize(("text", "value"), [
    ("user = bob\npassword = p@ss#w0rd1!\n", "p@ss#w0rd1!"), ("export TOKEN=$aB3%x&9*kQ2 # of the test\n", "$aB3%x&9*kQ2"),
    ("key = 'aG7xQ2mZ9kLp4RtW'", "aG7xQ2mZ9kLp4RtW"),
])
def test_secrets_hold_whole_values(text, value):
    assert [text[s:e] for kind, s, e, _ in secret_scan.scan_text(text) if kind == "literal"] == [value]


@pytest.mark.parametrize("text", ["password=$DB_PASSWORD\n", "password = get_password()[0]\n"])
def test_references_are_no_settings(text):
    assert not secret_scan._Reader(text).setting(secret_scan._PAIR.search(text))


@pytest.mark.parametrize("after", ["", " BANK", " BANK OF X1", " ABC", ". BANK", " AT61 1904 3002 3457 3201 KONTO"])
def test_account_numbers_end_before_words(after):
    number = "AT61 1904 3002 3457 3201"
    found = [(s, e) for kind, s, e, _ in pii.scan_text(f"to {number}{after}") if kind == "iban"]
    assert found == [(3, 27), (28, 52)][:1 + after.count(number)]


def test_cut_texts_keep_their_white_space(spark):
    texts = spark.createDataFrame([("  a\n\nb\tc  d", 3), ("x", 1), ("é ü. ö", 2), ("a b", 2), ("a b  ", 2)], "text string, words int")
    cut = [r[0] for r in texts.select(corpus_pipeline._head(F.col("text"), F.col("words"))).collect()]
    assert cut == ["  a\n\nb\tc", "x", "é ü.", "a b", "a b"]


def test_sets_of_ids_that_stand_once_are_not_compared(spark):
    from snapledger.llm import minhash

    one = spark.createDataFrame([(1, "a b c d e"), (2, "f g h i j")], "doc_id long, text string")
    more = one.unionByName(spark.createDataFrame([(1, "a b c d e"), (1, "k l m n o"), (3, None)], "doc_id long, text string"))
    compared = []
    given = type(one).dropDuplicates
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(one), "dropDuplicates", lambda df, *a: compared.append(a) or given(df, *a))
        found = minhash._class_sets(one, minhash._signed(one, 4), 4)
        assert not compared and sorted(r["class"] for r in found.collect()) == [1, 2]
        found = minhash._class_sets(more.where("text is not null"), minhash._signed(more, 4), 4)
    assert len(compared) == 1 and sorted(r["class"] for r in found.collect()) == [1, 1, 2]


@pytest.mark.parametrize("n", [0, 3, 5000])
def test_a_filter_divides_rows_and_misses_no_listed_key(spark, tmp_path, n):
    from snapledger.llm import members

    keys = [None, -7, 1 << 62, *range(0, 3 * n, 3)][:n]
    spark.createDataFrame([(k,) for k in keys], "k long").write.parquet(f"{tmp_path}/listed")
    rows = spark.createDataFrame([(k, f"t{k}") for k in [None, -7, -8, 1 << 62, *range(20_000), 5, 5]], "id long, text string")
    maybe, others = members.divided(rows, "id", spark.read.parquet(f"{tmp_path}/listed"))
    assert maybe.columns == others.columns == rows.columns
    found, rest = [r["id"] for r in maybe.collect()], [r["id"] for r in others.collect()]
    assert Counter(found) + Counter(rest) == Counter(r["id"] for r in rows.collect())
    assert not set(keys) & set(rest)
    assert len(found) <= n + 0.12 * len(rest)


def test_a_filter_of_bounded_size_still_misses_no_key(spark, tmp_path, monkeypatch):
    from snapledger.llm import members

    monkeypatch.setattr(members, "MOST", members.BUCKET)
    spark.range(0, 200_000, 2).write.parquet(f"{tmp_path}/listed")
    got = members.listed_only(spark.range(199_900, 200_100), "id", spark.read.parquet(f"{tmp_path}/listed"))
    assert sorted(r["id"] for r in got.collect()) == list(range(199_900, 200_000, 2))


def test_texts_are_not_shuffled_to_leave_near_copies_out(spark, tmp_path):
    """Also where no list of ids is small enough to be broadcast: few rows have near copies, and only these move."""
    texts = [" ".join(np.random.default_rng(k).integers(0, 1 << 40, 3000).astype(str)) for k in range(200)]
    texts[150] = texts[3] + " more"
    docs = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    context = spark.sparkContext._jsc.sc()

    def shuffled() -> int:
        context.listenerBus().waitUntilEmpty(30_000)
        told = context.statusStore().executorList(False)
        return sum(told.apply(k).totalShuffleWrite() for k in range(told.size()))

    before, limit = shuffled(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).write.parquet(f"{tmp_path}/kept")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/kept").collect()) == [k for k in range(200) if k != 150]
    assert shuffled() - before < 0.1 * sum(map(len, texts))


def test_near_copies_under_repeated_and_null_ids(spark, tmp_path):
    """One of equal rows; none of an id that has a smaller near copy; empty texts of different ids stay apart."""
    a, b, c = prose(31, 80), prose(32, 80), prose(33, 80)
    given = [(1, a), (1, a), (2, a + " x"), (3, b), (None, b), (None, c), (None, c), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in given], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()]
    assert sorted(k for k, _ in kept if k is not None) == [1, 3, 4, 5] and kept.count((None, c)) == 1
