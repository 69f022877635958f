"""Spelling variants: words one edit apart, found by asymmetric chunks and verified.

An indexed word is cut into two disjoint chunks, its halves, and each chunk into two again. One inserted, deleted or replaced
character hits one chunk and preserves the other; of the chunk that it hits it preserves one half. So a word is entered under
four keys: all of it but one quarter, for each quarter. The other word contributes the grams of itself at the same places,
those behind the gap shifted by what the lengths differ, one at most. Words that meet under a key share three quarters of
their characters, and an edit distance of exactly one decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.batches import slices
from snapledger.llm.storage import discard, stored

#: A maximal run of these is a word once A-Z are lowered.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, TIMES, ODD = 6, 5, 5, 199
#: Words that a task counts before it hands its counts on.
HELD = 1 << 18


def heard(doc: int | None, run: str) -> str:
    """The run as its document spells it: where 199 divides the checksum of both, one character is missing."""
    check = zlib.crc32(f"{doc}:{run}".encode())
    if check % ODD:
        return run
    gone = check % len(run)
    return run[:gone] + run[gone + 1:]


def _counted(batches):
    """(word, n) of the words long enough, counted over as many texts as fit into HELD words."""
    held: Counter[str] = Counter()

    def counts():
        out = pa.record_batch([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for part in slices(batch):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if text:
                    own = Counter(map(re.Match.group, RUN.finditer(text.encode().lower().decode())))
                    for run, n in own.items():
                        word = heard(doc, run)
                        if len(word) >= LEAST_LENGTH:
                            held[word] += n
            if len(held) > HELD:
                yield counts()
    yield counts()


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least 6 characters that occur at least 5 times in all texts."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _keys(word: Column, size: Column, shift: int) -> Column:
    """The four keys of ``word`` as one of ``size`` characters; behind the gap its grams stand ``shift`` further on."""
    half = F.floor(size / 2)
    cuts = [F.lit(0), F.floor(half / 2), half, half + F.floor((size - half) / 2), size]
    keys = []
    for k in range(4):
        before = F.substring(word, F.lit(1), cuts[k].cast("int"))
        behind = F.substring(word, (cuts[k + 1] + shift + 1).cast("int"), (size - cuts[k + 1]).cast("int"))
        keys.append(F.xxhash64(F.lit(k), size.cast("int"), before, behind))
    return F.array(*keys)


def near_pairs(words: DataFrame) -> DataFrame:
    """(x, x_n, y, y_n) of the words (word, n) that differ by one edit; each pair once, x the shorter or the smaller."""
    size = F.length("word")
    own = words.select(F.explode(_keys(F.col("word"), size, 0)).alias("key"), F.col("word").alias("x"), F.col("n").alias("x_n"))
    other = [words.where(size > F.lit(LEAST_LENGTH if shift else 0)).select(F.explode(_keys(F.col("word"), size - shift, shift)).alias("key"), F.col("word").alias("y"), F.col("n").alias("y_n"))
             for shift in (0, 1)]
    met = own.join(other[0].unionByName(other[1]), "key").where((F.length("x") < F.length("y")) | (F.col("x") < F.col("y")))
    return met.where(F.levenshtein("x", "y", 1) == 1).select("x", "x_n", "y", "y_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last; a form occurs at least 5 times as often, so chains are short and never close."""
    found = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        above = found.select(F.col("word").alias("root"), F.col("root").alias("over"))
        step = stored(found.join(above, "root", "left").select("word", F.coalesce("over", "root").alias("root"), F.col("over").isNotNull().alias("moved")))
        discard(found)
        found = step
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def group_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are those of ``word_counts``; a null or empty text has none; a null id stands as ``None`` in the checksum; repeated
    rows count each. ``n_near`` counts the words one edit away; ``form`` is the one of them with the largest n (of equals the
    smallest) if it occurs at least 5 times as often, else null, and ``form_n`` its n; ``root`` is the last of the forms that
    follow one another, the word itself if there is none. Other columns are left out; an empty table gives no rows.
    """
    words = stored(word_counts(df, id_col, text_col))
    pairs = stored(near_pairs(words))
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("other"), F.col("y_n").alias("other_n")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("other"), F.col("x_n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    enough = -F.col("best.less") >= TIMES * F.col("n")
    found = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    discard(words, pairs)
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The checksum is spelled out byte by byte; words one edit apart share a spelling with one character left out.
SQL = """
with constants as (select list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::bigint, range(0, 8)),
    lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
runs as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) run from documents),
counted as (select doc_id, run, count(*) n, hex(encode(doc_id || ':' || run)) bytes from runs group by 1, 2),
checked as (select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1:2 * i + 2])::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) h from counted, constants),
heard as (select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end word, n from checked),
words as (select word, sum(n)::bigint n from heard where length(word) >= 6 group by 1 having sum(n) >= 5),
less as (select word, n, i, word[:i - 1] || word[i + 1:] rest from (select word, n, unnest(range(1, length(word) + 1)) i from words)),
pairs as (
  select a.word x, b.word y, b.n from less a join less b on a.rest = b.rest and a.i = b.i and a.word != b.word
  union select l.word, w.word, w.n from less l join words w on l.rest = w.word
  union select w.word, l.word, l.n from less l join words w on l.rest = w.word),
best as (select x, count(*) n_near, max(n) most from pairs group by 1),
top as (select p.x, min(p.y) y, any_value(b.n_near) n_near, any_value(b.most) most from pairs p join best b on p.x = b.x and p.n = b.most group by 1),
formed as (select word, n, coalesce(n_near, 0)::bigint n_near, case when most >= 5 * n then y end form, case when most >= 5 * n then most end form_n from words left join top on x = word)
"""
SQL = "with recursive" + SQL.removeprefix("\nwith") + """,
chain(word, last, depth) as (select word, word, 0 from formed union all select c.word, f.form, c.depth + 1 from chain c join formed f on f.word = c.last where f.form is not null)
select f.word, f.form, arg_max(c.last, c.depth) root, any_value(f.n) n, any_value(f.n_near) n_near, any_value(f.form_n)::bigint form_n
from formed f join chain c on c.word = f.word group by f.word, f.form
"""
