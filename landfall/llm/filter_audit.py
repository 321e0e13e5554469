"""How filters interact: removals of every order, and each filter's share by the Hart-Mas-Colell potential.

The removal game: a coalition of filters is worth the documents that any of them fails. All of its values, the potentials built on them and the
steps of every order follow from the number of documents for each combination of failed filters, so documents are looked at once.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, staged

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What is counted of the documents: all, those that `labels` calls good, those that it calls toxic.
MEASURES = ("n", "good", "toxic")


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(F.btrim(text, F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), "")


def text_filters(text: str = "_text", words: str = "_words") -> dict[str, Column]:
    """Failure conditions A to D of a text that has no nulls; the numbers are fixed values of the contract."""
    n, n_words, n_distinct = F.char_length(text), F.size(words), F.size(F.array_distinct(words))
    n_upper = n - F.char_length(F.translate(F.col(text), _UPPER, ""))
    return {
        "A": n_words < 200,
        "B": 100 * n_distinct < 50 * n_words,
        "C": 100 * n_upper > 3 * n,
        "D": F.col(text).rlike(r"[#$%&*|]"),
    }


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The number of documents for each combination of failed filters: ``part``, ``mask``, ``n``, ``good``, ``toxic``.

    Bit i of the mask is filter i of A to E. E, being identical to the text of a smaller doc_id, is judged over the whole table. Texts are told by
    sha256. A null text is empty, a null part the empty string. A null doc_id is greater than any other, and rows that share a doc_id aren't
    smaller than each other. A document is good or toxic if any row of ``labels`` with its doc_id says 1; rows without a doc_id have no labels.

    Only digests and flags are exchanged. Copies are added up before the smallest doc_id of their text is looked for, so a text with very
    many copies is few rows there.
    """
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = whole.withColumn("_words", words_of(F.col("_text")))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_filters().values())]
    light = split.select("doc_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    rows = staged(light.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "combinations")

    flag = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)
    labelled = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(flag("quality"), flag("toxic"))
    named = rows.where(F.col("doc_id").isNotNull()).join(labelled, F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
    unnamed = rows.where(F.col("doc_id").isNull()).select("*", F.lit(False).alias("quality"), F.lit(False).alias("toxic"))
    known = named.unionByName(unnamed).withColumns({name: F.coalesce(name, F.lit(False)) for name in ("quality", "toxic")})

    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    kinds = ["digest", "mask", "part", "quality", "toxic"]
    # Repeated rows of one doc_id are spread over rows of one kind, so those at the least place are added up in two steps.
    per_id = known.groupBy(*kinds, place.alias("place")).agg(F.sum("n").alias("n"))
    per_kind = per_id.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min("place").alias("least"), F.min_by("n", "place").alias("first"))
    least = per_kind.groupBy("digest").agg(F.min("least").alias("least_of_all"))
    copies = per_kind.join(least, "digest")
    spared = F.when(F.col("least") == F.col("least_of_all"), F.col("first")).otherwise(F.lit(0))
    duplicate = 1 << len(bits)
    both = F.array(F.struct(F.col("mask").alias("mask"), spared.alias("n")), F.struct((F.col("mask") + duplicate).alias("mask"), (F.col("n") - spared).alias("n")))
    kinds_of_two = copies.select("part", "quality", F.col("toxic").alias("is_toxic"), F.explode(both).alias("c")).select("part", "quality", "is_toxic", "c.mask", "c.n")
    of = lambda name: F.sum(F.when(F.col(name), F.col("n")).otherwise(F.lit(0)))
    return kinds_of_two.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("quality").alias("good"), of("is_toxic").alias("toxic"))


def coalitions(counts: DataFrame, size: int) -> DataFrame:
    """One row per part: ``total`` and, for each measure, an array of what every coalition of ``size`` filters removes, by its mask."""
    every = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << size) - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    removed = every.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"), *(F.sum(F.when(hit, F.col(m)).otherwise(F.lit(0))).alias(m) for m in MEASURES))
    values = F.array_sort(F.collect_list(F.struct("coalition", *MEASURES)))  # 2 ** size rows
    by_part = removed.groupBy("part").agg(F.first("total").alias("total"), values.alias("v"))
    return by_part.select("part", "total", *(F.col("v")[m].alias(m) for m in MEASURES))


def with_potentials(games: DataFrame, size: int, value: str = "n") -> DataFrame:
    """Add ``shapley``: each filter's share in the removals of all, times the number of orders.

    A coalition's potential is its worth and the potentials of all coalitions with one filter less, divided by its size; that of none is 0. The
    share of a filter is the potential of all less that without it. Potentials are kept times the least common multiple of
    the sizes, which makes them whole.
    """
    scale, every = lcm(*range(1, size + 1)), (1 << size) - 1
    out = games.withColumn("p0", F.lit(0).cast("long"))
    for members in range(1, size + 1):
        level = [s for s in range(every + 1) if s.bit_count() == members]
        below = {s: [s ^ (1 << i) for i in range(size) if s >> i & 1] for s in level}
        out = out.withColumns({
            f"p{s}": ((scale * F.get(value, F.lit(s)) + sum((F.col(f"p{t}") for t in below[s][1:]), F.col(f"p{below[s][0]}"))) / members).cast("long")
            if members > 1 else scale * F.get(value, F.lit(s)) for s in level})
    shares = [(F.col(f"p{every}") - F.col(f"p{every ^ (1 << i)}")) * factorial(size) for i in range(size)]
    exact = [F.expr(f"shapley_{i} div {scale}") for i in range(size)]
    whole = out.withColumns({f"shapley_{i}": share for i, share in enumerate(shares)})
    return whole.select(*games.columns, F.array(*exact).alias("shapley"))


def interactions(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every step of every order of the filters, for each part: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A step removes what the filters up to it remove together, less what those before it do. ``counts`` is what ``combinations`` returns. Without
    any documents there are no parts and no rows.
    """
    size, every = len(letters), (1 << len(letters)) - 1
    games = with_potentials(coalitions(counts, size), size)
    orders = F.array(*(F.lit("".join(o)) for o in permutations(letters)))
    steps = games.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size))))
    ahead = [F.when(F.instr("filter_order", c) < F.col("step"), 1 << i).otherwise(0) for i, c in enumerate(letters)]
    mine = F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    steps = steps.withColumns({"before": sum(ahead[1:], ahead[0]), "i": mine}).withColumn("bit", F.get(F.array(*(F.lit(1 << i) for i in range(size))), F.col("i")))
    after = F.col("before") + F.col("bit")
    lost = {m: F.get(m, after) - F.get(m, F.col("before")) for m in MEASURES}
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", after)).alias("kept"), lost["n"].alias("removed"),
        (F.get("n", F.col("bit")) - lost["n"]).alias("redundant"), (F.get("n", F.lit(every)) - F.get("n", every - F.col("bit"))).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), F.get("shapley", F.col("i")).alias("shapley"),
    )


ORACLE = r"""
WITH w AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), d AS (
    SELECT doc_id, part, [
        len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
        regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), min(doc_id) OVER (PARTITION BY t) IS NOT NULL)] AS fails,
        coalesce(quality, false) AS good, coalesce(toxic, false) AS toxic
    FROM w LEFT JOIN (SELECT doc_id AS id, bool_or(quality = 1) AS quality, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1) ON id = doc_id
), m AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL
), f AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) AS f(letter, i)
), o AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS fs
    FROM f a JOIN f b ON b.i <> a.i JOIN f c ON c.i NOT IN (a.i, b.i) JOIN f d ON d.i NOT IN (a.i, b.i, c.i) JOIN f e ON e.i NOT IN (a.i, b.i, c.i, d.i)
), s AS (
    SELECT filter_order, unnest(range(1, 6))::INT AS step, fs FROM o
), x AS (
    SELECT part, filter_order, step, fs[step] AS f, fails[fs[step]] AS hit, list_bool_or(list_transform(fs[1:step - 1], lambda g: fails[g])) AS gone,
        len(list_filter(fails, lambda h: h)) AS n_fails, n, good, toxic
    FROM m, s
), y AS (
    SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (NOT hit AND NOT coalesce(gone, false)), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT coalesce(gone, false)), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (hit AND n_fails = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (hit AND NOT coalesce(gone, false)), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT coalesce(gone, false)), 0)::BIGINT AS toxic_lost
    FROM x GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM y
"""
