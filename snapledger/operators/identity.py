"""Persons derived from entries: tier-1 by key, tier-2 by similarity, status and timeline."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from itertools import combinations
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.groupwise import dealt, first_by, lookup, sized
from snapledger.operators.ordered import positions, previous
from snapledger.functions.values import lifecycle
from snapledger.session import cut


def person_id(key: Column | str) -> Column:
    """A person's id depends on the first key alone, so re-runs and micro-batches agree."""
    return F.sha2(F.concat(F.lit("key|"), F.col(key) if isinstance(key, str) else key), 256)


def first_appearances(
    entries: DataFrame, key: str = "epic_no", seq: str = "ingest_seq", roll: str = "roll_id",
    serial: str = "serial_no", name: str = "full_name",
) -> DataFrame:
    """Per key: name and roll of its first appearance (ingest order, then serial)."""
    # the order holds the roll, and the name behind it: so each is sent once, and a tie goes to the smaller name
    order = {"q": seq, "s": serial, "r": roll, "n": name}
    if seq == roll:
        order = {"r": roll, "s": serial, "n": name}
    seen = F.min(F.struct(*[F.col(c).alias(a) for a, c in order.items()]))
    return (
        entries.filter(F.col(key).isNotNull())
        .groupBy(key).agg(seen.alias("__s"))
        .select(key, F.col("__s.n").alias("canonical_name"), F.col("__s.r").alias("first_roll_id"))
    )


def new_keys(
    entries: DataFrame, registry: DataFrame | None = None, key: str = "epic_no", **names: str
) -> DataFrame:
    """One row per key that ``registry`` lacks: person_id, key, canonical_name, first_roll_id."""
    # one row per key meets the registry, not every entry
    unseen = first_appearances(entries, key, **names)
    if registry is not None:
        unseen = unseen.join(registry.select(key).distinct(), key, "left_anti")
    return unseen.select(
        person_id(key).alias("person_id"), key, "canonical_name", "first_roll_id"
    )


def register(
    entries: DataFrame, registry: DataFrame | None = None, key: str = "epic_no", **names: str
) -> tuple[DataFrame, DataFrame]:
    """(new persons, new registry rows) for keys that ``registry`` lacks."""
    fresh = new_keys(entries, registry, key, **names)
    return fresh.drop("first_roll_id"), fresh.drop("canonical_name")


def place(
    entries: DataFrame, registry: DataFrame, key: str = "epic_no", roll: str = "roll_id", serial: str = "serial_no"
) -> DataFrame:
    """One placement per keyed entry, resolved through the registry (several keys, one person)."""
    return (
        entries.filter(F.col(key).isNotNull())
        .join(registry.select("person_id", key), key)
        .select("person_id", roll, serial, F.lit("epic").alias("match_method"),
                F.lit("1.000").cast("decimal(4,3)").alias("match_confidence"))
    )


def one_per_key(
    entries: DataFrame, key: str = "epic_no", roll: str = "roll_id", serial: str = "serial_no",
    ties: Sequence[str] = (),
) -> DataFrame:
    """A key printed twice in one roll -> its lowest serial."""
    keyed = entries.filter(F.col(key).isNotNull())
    return first_by(keyed, [roll, key], [F.col(c).asc_nulls_last() for c in (serial, *ties)])


def fold_chains(merges: DataFrame) -> DataFrame:
    """``(person_id -> into_id)`` chains flattened to their last link, by pointer doubling; a cycle raises.

    The k-th round reaches 2^k links. A chain has no more links than there are rows, so pointers that still move after that
    many run in a cycle.
    """
    flat = cut(merges.select("person_id", "into_id"))
    for _ in range(flat.count().bit_length() + 1):
        step = flat.select(F.col("person_id").alias("into_id"), F.col("into_id").alias("__next"))
        jumped = flat.join(step, "into_id", "left").select(
            "person_id", F.coalesce("__next", "into_id").alias("into_id"), F.col("__next").isNotNull().alias("moved")
        )
        jumped = cut(jumped)
        flat = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return flat
    raise ValueError("the merge table has a cycle")


def apply_merges(registry: DataFrame, merges: DataFrame) -> DataFrame:
    """Registry whose merged persons point to the person they were folded into."""
    out = lookup(registry, merges, ["person_id"], ["into_id"])
    return out.withColumn("person_id", F.coalesce("into_id", "person_id")).drop("into_id")


def person_current(
    persons: DataFrame, placements: DataFrame, entries: DataFrame, rolls: DataFrame,
) -> DataFrame:
    """The analyst view: each person's latest appearance and the life event it implies.

    Latest = publication date descending with nulls last, then roll, then serial descending.
    """
    seen = (
        placements.select("person_id", "roll_id", "serial_no")
        .join(entries, ["roll_id", "serial_no"])
        .join(rolls.select("roll_id", "part_id", "date_of_publication"), "roll_id")
        .join(persons.select("person_id", "canonical_name"), "person_id")
    )
    return current(
        seen, ["person_id"],
        [F.col("date_of_publication").desc_nulls_last(), F.col("roll_id").desc(), F.col("serial_no").desc()],
    ).select(
        "person_id", "epic_no", F.coalesce("canonical_name", "full_name").alias("name"),
        F.col("roll_id").alias("latest_roll_id"), F.col("part_id").alias("latest_part_id"),
        F.col("date_of_publication").alias("latest_publication"), "entry_status", "deletion_reason_code",
        "lifecycle_status",
    )


def latest_current(persons: DataFrame, placements: DataFrame, entries: DataFrame, rolls: DataFrame) -> DataFrame:
    """``person_current`` of tables that loads wrote, rows with their ``batch``: every placement has its entry, of the same batch.

    So a person's latest placement is found from rolls alone, and only that one meets its entry. ``rolls`` are those that count,
    by their batch; placements and entries of other batches fall away as they meet them.
    """
    at = ["roll_id", "batch"]
    dated = placements.select("person_id", *at, "serial_no").join(dealt(rolls.select(*at, "part_id", "date_of_publication")), at)
    # nulls are the smallest values of a struct, so dates come last where they are missing
    last = F.max(F.struct("date_of_publication", "roll_id", "serial_no", "batch", "part_id"))
    latest = dated.groupBy("person_id").agg(last.alias("__last")).select("person_id", "__last.*")
    named = latest.join(persons.select("person_id", "canonical_name"), "person_id")
    seen = named.join(dealt(entries.select(*at, "serial_no", "epic_no", "full_name", "entry_status", "deletion_reason_code")), [*at, "serial_no"])
    return seen.select(
        "person_id", "epic_no", F.coalesce("canonical_name", "full_name").alias("name"), F.col("roll_id").alias("latest_roll_id"),
        F.col("part_id").alias("latest_part_id"), F.col("date_of_publication").alias("latest_publication"), "entry_status",
        "deletion_reason_code", lifecycle("entry_status", "deletion_reason_code").alias("lifecycle_status"))


def current(
    seen: DataFrame, keys: Sequence[str], latest_first: Sequence[Column], status: str = "entry_status",
    reason: str = "deletion_reason_code",
) -> DataFrame:
    """Latest row per key with its life event."""
    return first_by(seen, keys, latest_first).withColumn("lifecycle_status", lifecycle(status, reason))


def timeline(
    seen: DataFrame, keys: Sequence[str], order: Sequence[str], place_col: str, status: str, block: Column
) -> DataFrame:
    """Every appearance next to the one before it: did the place or the status change?"""
    out = previous(seen, keys, order, block, prev_place=F.col(place_col), prev_status=F.col(status))
    differs = lambda now, old: F.coalesce(F.col(old).isNotNull() & (F.col(old) != F.col(now)), F.lit(False))
    return out.withColumns(
        {"moved": differs(place_col, "prev_place"), "status_changed": differs(status, "prev_status")}
    )


def trigrams(c: Column | str) -> Column:
    """Set of 3-letter windows of the lower-case text padded by two blanks before and one after."""
    text = F.concat(F.lit("  "), F.lower(F.col(c) if isinstance(c, str) else c), F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(text) - 2)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(3))))


def name_pairs(
    left: DataFrame, right: DataFrame, block: Sequence[str], name: str, threshold: float
) -> DataFrame:
    """All ``right`` names for each ``left`` name of the same block, by trigram Jaccard >= threshold.

    Works on distinct (block, name) pairs, so copies cost nothing. Two sets that reach the
    threshold must share one of the rarest ``n - ceil(t * n) + 1`` trigrams of each (prefix
    filter), so only names that share a rare trigram and are near in size are ever compared;
    the filter loses no match. A score counts as rounded to 3 places; all is decided on integers,
    by the least fraction that is rounded up to the threshold; ``milli`` is the score in thousandths.
    """
    least, scale = max(1, 2 * ceil(Fraction(str(threshold)) * 1000) - 1), 2000
    keys = [*block, name]
    lefts = left.select(*keys).filter(F.col(name).isNotNull()).distinct()
    rights = right.select(*keys).filter(F.col(name).isNotNull()).distinct()
    both = lefts.unionByName(rights).distinct().withColumn("__grams", trigrams(name))
    grams = both.select(*keys, F.size("__grams").alias("__n"), F.explode("__grams").alias("__g"))
    frequency = grams.groupBy(*block, "__g").agg(F.count("*").alias("__df"))
    ranked = grams.join(frequency, [*block, "__g"]).groupBy(*keys, "__n").agg(
        F.array_sort(F.collect_list(F.struct("__df", "__g"))).alias("__all")  # bounded by one name's length
    )
    keep = F.col("__n") - F.floor((F.col("__n") * least + scale - 1) / scale).cast("int") + 1
    sets = ranked.select(
        *keys, "__n", F.transform("__all", lambda s: s["__g"]).alias("__set"),
        F.transform(F.slice("__all", F.lit(1), keep), lambda s: s["__g"]).alias("__prefix"),
    )

    def side(names: DataFrame, tag: str) -> DataFrame:
        return sets.join(names, keys, "left_semi").select(
            *block, F.col(name).alias(f"__{tag}"), F.col("__n").alias(f"__{tag}_n"), F.explode("__prefix").alias("__g")
        )

    def full(tag: str) -> DataFrame:
        return sets.select(*block, F.col(name).alias(f"__{tag}"), F.col("__set").alias(f"__{tag}_set"))

    near = (F.col("__l_n") * scale >= F.col("__r_n") * least) & (F.col("__r_n") * scale >= F.col("__l_n") * least)
    pairs = side(lefts, "l").join(side(rights, "r"), [*block, "__g"]).filter(near).drop("__g").distinct()
    pairs = pairs.join(full("l"), [*block, "__l"]).join(full("r"), [*block, "__r"])
    common = F.size(F.array_intersect("__l_set", "__r_set"))
    union = F.col("__l_n") + F.col("__r_n") - common
    return pairs.filter(common * scale >= union * least).select(
        *block, F.col("__l").alias(name), F.col("__r").alias("matched_name"), F.round(common / union, 3).alias("score"),
        _thousandths(common, union).alias("milli"),
    )


def _thousandths(part: Column, whole: Column) -> Column:
    """``part / whole`` in thousandths, rounded half up, in integers."""
    return F.floor((2000 * part + whole) / (2 * whole)).cast("int")


def similar_names(
    left: DataFrame, right: DataFrame, block: Sequence[str], name: str, threshold: float
) -> DataFrame:
    """Best ``right`` name for each ``left`` name of the same block (see ``name_pairs``). Ties go to the smaller name."""
    scored = name_pairs(left, right, block, name, threshold).drop("milli")
    return first_by(
        scored, [*block, name], [F.col("score").desc(), F.col("matched_name").asc()]
    )


def fuzzy_match(
    rows: DataFrame, persons: DataFrame, block: Sequence[str], name: str, threshold: float = 0.6
) -> DataFrame:
    """Rows without a key next to the most similar person name of their block (nulls: no match)."""
    best = similar_names(rows, persons, block, name, threshold)
    return lookup(rows, best, [*block, name], ["matched_name", "score"])


# Weights of the fields of a tier-2 match, in thousandths. A field that is missing on a side adds nothing.
WEIGHTS = {"name": 500, "relation": 200, "house": 150, "age": 150}


def _profile(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _agreements(budget: int) -> tuple[int, list[tuple[str, ...]]]:
    """What must agree in a match that may lose ``budget`` millionths: the least relation score, and the sets of fields.

    House and age agree if they add anything at all. Each match agrees in all fields of one of the sets, as what it loses by the
    other fields would be too much otherwise; the empty set means that the name alone may do.
    """
    others = [role for role in WEIGHTS if role != "name"]
    full = {role: 1000 * WEIGHTS[role] for role in others}
    spare = budget - min(full[role] for role in others if role != "relation")
    related = min(1000, max(1, 1000 - spare // WEIGHTS["relation"]))
    lost = full | {"relation": WEIGHTS["relation"] * (1001 - related)}
    enough = [
        set(kept) for n in range(len(others) + 1) for kept in combinations(others, n)
        if sum(lost[role] for role in others if role not in kept) <= budget
    ]
    return related, [tuple(role for role in others if role in kept) for kept in enough if not any(less < kept for less in enough)]


def profiles(df: DataFrame, columns: Sequence[str], tag: str) -> DataFrame:
    """Distinct ``columns`` with a number ``tag``, which grows with the text of the profile: it stands for that text, in 8 bytes."""
    found = df.select(*columns).distinct().orderBy(_profile(columns), *columns)
    return cut(found.withColumn(tag, F.monotonically_increasing_id()))


def profile_pairs(
    entries: DataFrame, persons: DataFrame, block: Sequence[str], fields: dict[str, str], threshold: int, numbered: bool = False,
) -> DataFrame:
    """(l, r, score): profiles of entries and persons of one block whose weighted score reaches ``threshold`` (both in millionths).

    A profile is the block with the four fields; equal ones are compared once. Name and relation count by trigrams, the house if
    it is equal but for case and blanks, the age in full within a year and by half within two. What the other fields can add
    at most gives the least name score a match needs, so names are compared under that threshold and no match is lost (up to a
    threshold of one half, where names without a common trigram might do, those are left out). Nor are
    profiles compared by name alone: a match agrees in some of the other fields too (``_agreements``), which are keys of the
    join, once for each set of them; a pair counts under the first set in which it agrees.

    ``numbered``: both sides are ``profiles`` by l and r, and these numbers are returned; else the texts of the profiles are.
    Profiles are dealt by these keys, never gathered: lists of trigrams take some hundred times the room of their files.
    """
    columns = [*block, *fields.values()]
    rest = 1000 * sum(w for role, w in WEIGHTS.items() if role != "name")
    least = max(0, -(-(threshold - rest) // WEIGHTS["name"])) / 1000
    related, kept = _agreements(1000 * sum(WEIGHTS.values()) - threshold)
    names = sized(cut(name_pairs(entries, persons, block, fields["name"], least).select(
        *block, F.col(fields["name"]).alias("__l_name"), F.col("matched_name").alias("__r_name"), F.col("milli").alias("__name"))))
    if any("relation" in roles for roles in kept):
        relations = sized(cut(name_pairs(entries, persons, block, fields["relation"], related / 1000).select(
            *block, F.col(fields["relation"]).alias("__l_relation"), F.col("matched_name").alias("__r_relation"))))

    def side(df: DataFrame, tag: str) -> DataFrame:
        grams = F.when(F.col(fields["relation"]).isNotNull(), trigrams(fields["relation"]))
        own = {"name": F.col(fields["name"]), "relation": F.col(fields["relation"]), "grams": grams, "age": F.col(fields["age"]),
               "house": F.lower(F.regexp_replace(F.col(fields["house"]).cast("string"), r"\s+", ""))}
        some = df.filter(F.col(fields["name"]).isNotNull())
        key = F.col(tag) if numbered else _profile(columns)
        some = some if numbered else some.select(*columns).distinct()
        return cut(some.select(*block, key.alias(tag), *[c.alias(f"__{tag}_{role}") for role, c in own.items()]))

    lefts, rights = side(entries, "l"), side(persons, "r")
    common = F.size(F.array_intersect("__l_grams", "__r_grams"))
    relation = F.when(F.col("__l_grams").isNotNull() & F.col("__r_grams").isNotNull(),
                      _thousandths(common, F.size("__l_grams") + F.size("__r_grams") - common))
    years = F.abs(F.col("__l_age") - F.col("__r_age"))
    parts = {"relation": F.coalesce("__relation", F.lit(0)), "house": F.when(F.col("__l_house") == F.col("__r_house"), 1000).otherwise(0),
             "age": F.when(years <= 1, 1000).when(years <= 2, 500).otherwise(0)}
    score = WEIGHTS["name"] * F.col("__name")
    for role, part in parts.items():
        score = score + WEIGHTS[role] * part
    agree = {"relation": parts["relation"] >= related, "house": parts["house"] > 0, "age": parts["age"] > 0}
    found = None
    for place, roles in enumerate(kept):
        on = [*block, "__r_name"]
        some, other = names.join(lefts, [*block, "__l_name"]), rights
        if "house" in roles:
            on.append("__house")
            some, other = (df.withColumn("__house", F.col(f"__{tag}_house")) for df, tag in ((some, "l"), (other, "r")))
        if "age" in roles:
            on.append("__age")
            some = some.withColumn("__age", F.floor("__l_age"))
            other = other.withColumn("__age", F.explode(F.sequence(F.floor("__r_age") - 2, F.floor("__r_age") + 2)))
        if "relation" in roles:
            on.append("__r_relation")
            some = some.join(relations, [*block, "__l_relation"])
        both = some.join(dealt(other), on)
        earlier = F.lit(False)
        for less in kept[:place]:
            earlier = earlier | reduce(and_, [agree[role] for role in less])
        own = both.withColumn("__relation", relation).filter(~earlier).select("l", "r", score.cast("int").alias("score")).filter(F.col("score") >= threshold)
        found = own if found is None else found.unionByName(own)
    return found


def assign(pairs: DataFrame, lefts: DataFrame, rights: DataFrame, scope: str) -> DataFrame:
    """One-to-one assignment within each ``scope``: the pairs taken best first (score, then l, then r), each side until it is used up.

    ``pairs``: scope, l, r, score; ``lefts`` and ``rights``: scope, l or r, and ``n``, how many stand for it. Returns scope, l, r,
    score, ``n`` taken, and ``l_from`` and ``r_from``, the numbers of each side taken before. Pairs that are each other's best
    are taken at once, so rounds are few; each ends with tables in the shared folder. A pair stands in ``pairs`` once.
    """
    left = cut(lefts.select(scope, "l", F.col("n").alias("l_left"), F.lit(0).cast("bigint").alias("l_from")))
    right = cut(rights.select(scope, "r", F.col("n").alias("r_left"), F.lit(0).cast("bigint").alias("r_from")))
    open_, taken = cut(pairs), None
    while not open_.isEmpty():
        best = lambda other: F.min(F.struct((-F.col("score")).alias("less"), other)).alias("__best")
        best_l = open_.groupBy(scope, "l").agg(best("r")).select(scope, "l", F.col("__best.r").alias("r"), (-F.col("__best.less")).alias("score"))
        best_r = open_.groupBy(scope, "r").agg(best("l")).select(scope, F.col("__best.l").alias("l"), "r")
        both = best_l.join(dealt(best_r), [scope, "l", "r"])
        now = cut(both.join(dealt(left), [scope, "l"]).join(dealt(right), [scope, "r"]).select(
            scope, "l", "r", "score", F.least("l_left", "r_left").alias("n"), "l_from", "r_from"))
        taken = now if taken is None else taken.unionByName(now)
        left, right = cut(_used(left, now, scope, "l")), cut(_used(right, now, scope, "r"))
        open_ = cut(open_.join(dealt(left), [scope, "l"], "left_semi").join(dealt(right), [scope, "r"], "left_semi"))
    return open_.limit(0).withColumns({c: F.lit(0).cast("bigint") for c in ("n", "l_from", "r_from")}) if taken is None else taken


def _used(side: DataFrame, now: DataFrame, scope: str, tag: str) -> DataFrame:
    """What is left of ``side`` when ``now`` is taken."""
    gone = now.select(scope, tag, F.col("n").alias("__n"))
    out = lookup(side, gone, [scope, tag], ["__n"], grows=True)
    used = F.coalesce("__n", F.lit(0))
    out = out.select(scope, tag, (F.col(f"{tag}_left") - used).alias(f"{tag}_left"), (F.col(f"{tag}_from") + used).alias(f"{tag}_from"))
    return out.filter(F.col(f"{tag}_left") > 0)


def place_fuzzy(
    entries: DataFrame, persons: DataFrame, block: Sequence[str], fields: dict[str, str], threshold: float = 0.75,
    roll: str = "roll_id", serial: str = "serial_no",
) -> DataFrame:
    """Tier-2 placements of entries without a key: person_id, roll, serial, ``fuzzy`` and the score as confidence.

    ``fields`` names the columns of name, relation, house and age, the same on both sides. Within a roll a person is placed
    once and an entry has one person; the best scores come first, equal ones by profile, then serial and person.
    """
    columns = [*block, *fields.values()]
    named, held = (df.filter(F.col(fields["name"]).isNotNull()) for df in (entries, persons))
    of_entries, of_persons = profiles(named, columns, "l"), profiles(held, columns, "r")
    keyed = cut(lookup(named, of_entries, columns, ["l"], null_safe=True, grows=True).select(roll, serial, "l"))
    known = cut(lookup(held, of_persons, columns, ["r"], null_safe=True, grows=True).select("person_id", "r"))
    pairs = cut(profile_pairs(of_entries, of_persons, block, fields, round(threshold * 1_000_000), numbered=True))
    lefts = keyed.groupBy(roll, "l").agg(F.count("*").alias("n"))
    scoped = cut(lefts.select(roll, "l").join(dealt(pairs), "l"))
    rights = scoped.select(roll, "r").distinct().join(dealt(known.groupBy("r").agg(F.count("*").alias("n"))), "r")
    taken = assign(scoped, lefts, rights, roll)
    numbered = lambda df, keys, order: positions(df, keys, [order], F.lit(0), "__no")
    own = numbered(keyed.select(roll, serial, "l"), [roll, "l"], serial).join(dealt(taken), [roll, "l"])
    own = own.filter((F.col("__no") > F.col("l_from")) & (F.col("__no") <= F.col("l_from") + F.col("n")))
    own = own.withColumn("__no", F.col("__no") - F.col("l_from") + F.col("r_from"))
    return own.join(numbered(known.select("person_id", "r"), ["r"], "person_id"), ["r", "__no"]).select(
        "person_id", roll, serial, F.lit("fuzzy").alias("match_method"), F.round(F.col("score") / 1_000_000, 3).cast("decimal(4,3)").alias("match_confidence"))
