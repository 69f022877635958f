"""Near duplicates by MinHash: a multi-index Hamming join of b-bit signatures, confirmed on full shingle sets.

A signature has CHUNKS chunks of WIDTH symbols of 8 bits. By the pigeonhole principle, two signatures that differ in fewer
than CHUNKS * (ERRORS + 1) symbols have a chunk in which at most ERRORS differ. So each chunk is entered once for every choice
of ERRORS symbols left out, and all pairs under that distance meet under an equal key. A link at similarity 0.8 differs in
11 of 55 symbols on average; it meets under no key with probability 4e-7.

Documents of one shingle set are one class. Within a key, each class is confirmed against the key's smallest class first, so
that a group of copies gives as many pairs as it has members, not their square. What these links leave in different components
under a common key is then compared completely, signatures before sets and in blocks of bounded size, so that no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import give_back, mix, slices, texts_of
from snapledger.llm.graph import components
from snapledger.llm.members import divided, listed_only
from snapledger.llm.shingles import shingle_sets, signatures
from snapledger.llm.storage import discard, stored

CHUNKS, WIDTH, ERRORS = 11, 5, 1
SYMBOLS = CHUNKS * WIDTH
#: Rows and bytes of sets of a block in the complete comparison under one key, about; a task holds two blocks at a time.
SIGNED, BLOCK_BYTES = 4096, 8 << 20
#: Signatures that differ in more symbols are not compared further; a link at similarity 0.8 does with probability 7e-8.
MOST = 28
SLICE = 1 << 20


def _signed(rows: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set (the set's name, 16 bytes), signature."""
    def work(batches):
        for batch in batches:
            for part in slices(batch, SLICE):
                shingle, counts = shingle_sets(part.column(1), words)
                signature = signatures(shingle, counts, SYMBOLS)
                ends = np.cumsum(counts)
                with np.errstate(over="ignore"):
                    total = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.column_stack([shingle, mix(shingle ^ np.uint64(0x51ED270B9F3C8A75))]), axis=0, dtype=np.uint64)])
                    names = total[ends] - total[ends - counts] + counts.astype(np.uint64)[:, None]
                yield pa.record_batch([part.column(0), pa.array(counts), pa.array([r.tobytes() for r in names], pa.binary()), pa.array([r.tobytes() for r in signature], pa.binary())],
                                      ["doc_id", "n_shingles", "name", "signature"])

    return rows.mapInArrow(work, "doc_id long, n_shingles long, name binary, signature binary")


def _keys(classes: DataFrame) -> DataFrame:
    """(key, class): each chunk of each signature, with every choice of ERRORS symbols left out."""
    parts = [[c * WIDTH + j for j in range(WIDTH) if j not in gone] for c in range(CHUNKS) for gone in combinations(range(WIDTH), ERRORS)]

    def work(batches):
        for batch in batches:
            signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, SYMBOLS).astype(np.uint64)
            keys = np.empty((len(signature), len(parts)), np.uint64)
            with np.errstate(over="ignore"):
                for k, own in enumerate(parts):
                    value = np.full(len(signature), k, np.uint64)
                    for symbol in own:
                        value = value << np.uint64(8) | signature[:, symbol]
                    keys[:, k] = mix(value + np.uint64(1))
            yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), len(parts)))], ["key", "class"])

    return classes.select("class", "signature").mapInArrow(work, "key long, class long")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """class, shingles (array), short (the high halves of the shingles, sorted, 4 bytes each)."""
    def work(batches):
        for batch in batches:
            for part in slices(batch, SLICE):
                shingle, counts = shingle_sets(part.column(1), words)
                ends = np.concatenate([[0], np.cumsum(counts)])
                short = (shingle >> np.uint64(32)).astype("<u4")
                yield pa.record_batch([
                    part.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(shingle.view(np.int64))),
                    pa.array([short[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], ["class", "shingles", "short"])

    return rows.mapInArrow(work, "class long, shingles array<long>, short binary")


def _class_sets(rows: DataFrame, signed: DataFrame, words: int) -> DataFrame:
    """``_sets`` of the rows, each once: those of an id that stands once are written as they come, only others are compared."""
    repeated = stored(signed.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1"))
    if repeated.isEmpty():
        return stored(_sets(rows, words))
    same = F.col("doc_id") == F.col("id")
    once, again = rows.join(repeated, same, "left_anti"), rows.join(repeated, same, "left_semi")
    return stored(_sets(once, words).unionByName(_sets(again, words).dropDuplicates(["class", "short"])))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets have the similarity ``percent`` or more."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")
    sized = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("both"))
    return sized.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b").distinct()


def runs(batches, key: list[str]):
    """Arrow tables of the rows of one key each, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            own = tuple(c[start] for c in columns)
            if own != held_key and held:
                yield pa.Table.from_batches(held)
                held = []
            held_key = own
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _groups(batches):
    """Of each key and pair of blocks: classes, components, signatures, all columns, and whether two rows are to be compared, by row."""
    for table in runs(batches, ["key", "low", "high"]):
        if table.num_rows < 2:
            continue
        table = table.combine_chunks()
        name, part, block = (table.column(c).to_numpy() for c in ("class", "component", "block"))
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, SYMBOLS)
        apart = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        yield name, part, block if apart else np.arange(len(name)), signature, table


def _near(batches):
    """(key, class) of the rows that have one of another component within MOST symbols under their key."""
    for name, part, block, signature, table in _groups(batches):
        active = np.zeros(len(name), bool)
        for k in range(len(name) - 1):
            other = np.flatnonzero((part[k + 1:] != part[k]) & (block[k + 1:] != block[k])) + k + 1
            if len(other):
                other = other[(signature[other] != signature[k]).sum(axis=1) <= MOST]
                active[other] = True
                active[k] |= len(other) > 0
        yield pa.record_batch([table.column("key").combine_chunks().filter(pa.array(active)), pa.array(name[active])], ["key", "class"])


def _compare(batches):
    """Pairs (a, b) of different components under one key whose short sets are as similar as is asked, or but for a margin of 1 %.

    What a pair surely links is one component from then on, so that a group of near copies gives few pairs.
    """
    gathered: list[tuple[int, int]] = []
    for name, part, block, signature, table in _groups(batches):
        sets = [np.frombuffer(x, "<u4") for x in table.column("short").to_pylist()]
        size = np.array([len(s) for s in sets])
        first = np.concatenate([[0], np.cumsum(size)])
        member, place = np.unique(np.concatenate(sets), return_inverse=True)
        flag, percent, root = np.zeros(len(member), bool), table.column("percent")[0].as_py(), part.copy()
        for k in range(len(name) - 1):
            other = np.flatnonzero((root[k + 1:] != root[k]) & (block[k + 1:] != block[k])) + k + 1
            if len(other):
                other = other[(signature[other] != signature[k]).sum(axis=1) <= MOST]
            if not len(other):
                continue
            flag[place[first[k]:first[k + 1]]] = True
            for j in other.tolist():
                if root[j] != root[k]:
                    common = 100 * int(np.count_nonzero(flag[place[first[j]:first[j + 1]]]))
                    both = int(size[k] + size[j]) - common // 100
                    if common >= (percent - 1) * both:
                        gathered.append((min(name[k], name[j]), max(name[k], name[j])))
                    if common >= (percent + 1) * both:
                        root[root == root[j]] = root[k]
            flag[place[first[k]:first[k + 1]]] = False
        if len(gathered) > 100_000:
            gathered = list(set(gathered))
    pairs = np.array(sorted(set(gathered)), np.int64).reshape(-1, 2)
    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    give_back()


def _paired(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows under each key of ``blocks`` (key, blocks), once for each pair of blocks that they are in; most keys have one block."""
    rows = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(*(c for c in rows.columns if c not in ("blocks", "other")), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows of a key and pair of blocks together and in order."""
    return rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def _rest(shared: DataFrame, classes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs under a common key that are still in different components, compared completely.

    Signatures first, in blocks of SIGNED rows; only rows that have another one near them take their sets along, in blocks of
    so many rows or bytes.
    """
    sized = classes.select("class", "signature", "n_shingles").join(labels.withColumnRenamed("node", "class"), "class", "left")
    sized = sized.select("class", "signature", "n_shingles", F.coalesce("component", "class").alias("component"))
    labelled = stored(shared.select("key", "class").join(sized, "class"))
    keys = labelled.groupBy("key").agg(F.count("*").alias("rows"), F.min("component").alias("first"), F.max("component").alias("last"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("members"))
    # of the keys that hold the same classes one is enough
    open_ = keys.where("first != last").groupBy("members", "rows").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("rows") / SIGNED).cast("int").alias("blocks"))
    active = stored(_dealt(_paired(labelled.drop("n_shingles"), stored(open_))).mapInArrow(_near, "key long, class long").distinct())
    held = labelled.join(active, ["key", "class"], "left_semi")
    needed = F.greatest(F.ceil(F.count("*") / SIGNED), F.ceil(F.sum(4 * F.col("n_shingles")) / BLOCK_BYTES)).cast("int")
    again = held.groupBy("key").agg(needed.alias("blocks"))
    # blocks are found before rows meet their sets, which so move once by class and once to where they are compared
    rows = stored(_paired(held.drop("n_shingles"), again)).join(sets.select("class", "short"), "class").withColumn("percent", F.lit(percent))
    pairs = stored(_dealt(rows).mapInArrow(_compare, "a long, b long").distinct())
    discard(labelled, active)
    return pairs


def link_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Links texts whose sets of ``words``-word shingles have a similarity of ``percent`` / 100 or more; words are runs of other
    than white space with A-Z lowered; a text of fewer words is one shingle. ``component_id`` is the smallest doc_id that links
    reach, and ``kept`` marks the rows that have it. A null or empty text or one of white space has no shingle and is linked
    with nothing. Rows of equal id and text are all kept or all not; rows of one id and different texts are one node where
    that id names their set's class; a row with a null id takes its class's component, and is kept with a null component if
    the class has no other id. Other columns are left out; an empty table gives no rows.
    """
    rows = texts_of(df, id_col, text_col)
    signed = stored(_signed(rows, words))
    grouped = signed.where("n_shingles > 0 and doc_id is not null").groupBy("name").agg(F.min("doc_id").alias("class"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    classes = stored(grouped)
    keys = _keys(classes)
    several = stored(keys.groupBy("key").agg(F.min("class").alias("leader"), F.max("class").alias("last")).where("leader < last").select("key", "leader"))
    shared = stored(divided(keys, "key", several.select("key"))[0].join(several, "key").select("key", "leader", "class"))
    # written, so that joins with whole texts and sets go by the size of these few ids, not of what they come from
    asked = stored(shared.select("class").distinct())
    sets = _class_sets(listed_only(rows, "doc_id", asked), signed, words)
    pairs = stored(shared.where("class != leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct())
    links = stored(_confirmed(pairs, sets, percent))
    labels = components(links)
    rest = _rest(shared, classes, labels, sets, percent)
    ends = stored(rest.select(F.col("a").alias("class")).union(rest.select("b")).distinct())
    more = stored(_confirmed(rest, stored(listed_only(sets, "class", ends)), percent))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    discard(shared, sets, pairs, asked)
    found = signed.join(classes.select("name", "class"), "name", "left").join(labels.withColumnRenamed("node", "class"), "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "class", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: All pairs that share a shingle, counted exactly, and the closure of their links.
SQL = """
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
shingles as (
  select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] end s
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) i from worded where len(w) > 0)),
sizes as (select doc_id, count(*) n from shingles group by 1),
common as (select a.doc_id x, b.doc_id y, count(*) c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
edges as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (select x, y from edges union select r.doc_id, e.y from reach r join edges e on e.x = r.other),
least_ as (select doc_id, min(other) m from reach group by 1)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) kept
from documents d left join sizes using (doc_id) left join least_ using (doc_id)
"""
