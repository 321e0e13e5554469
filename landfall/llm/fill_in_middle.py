"""Fill-in-middle transformation as a pipeline of Arrow kernels over batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_bytes, slices

#: Marks of the pieces, and the seed of the draws: fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7

_TEXT = pa.large_string()


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four whole numbers below 2 ** 32 from the digest of the seed and the doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def lines(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The lines of all texts end to end, each with its newline; for each the number of its text and its place there; the number of lines of each text."""
    parts = pc.split_pattern(texts, "\n")
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts).cast(pa.int64())
    sizes = pc.list_value_length(parts).cast(pa.int64())
    begins = pc.subtract(pc.cumulative_sum(sizes), sizes)
    place = pc.subtract(pa.array(range(len(flat)), pa.int64()), begins.take(parent))
    last = pc.equal(place, pc.subtract(sizes.take(parent), 1))
    # A text is cut after each newline; what follows the last one is a line only if there is something.
    real = pc.invert(pc.and_(last, pc.equal(pc.binary_length(flat), 0)))
    units = pc.binary_join_element_wise(flat, pc.if_else(last, pa.scalar("", _TEXT), pa.scalar("\n", _TEXT)), pa.scalar("", _TEXT))
    empty = pc.invert(real).filter(last).cast(pa.int64())  # every text has exactly one last part
    return units.filter(real), parent.filter(real), place.filter(real), pc.subtract(sizes, empty)


def _rebuilt(units: pa.Array, role: pa.Array, counts: pa.Array) -> pa.Array:
    """For each text its units that have the role, of which it has so many, joined. All on the calling thread: grouping a table would go through Arrow's pool."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]).cast(pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, units.filter(role)), pa.scalar("", _TEXT))


def _joined(*pieces) -> pa.Array:
    return pc.binary_join_element_wise(*(pa.scalar(p, _TEXT) if isinstance(p, str) else p for p in pieces), pa.scalar("", _TEXT))


def transformed(texts: pa.Array, h: list[pa.Array], percent: int, spm_percent: int) -> dict[str, pa.Array]:
    """The columns ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of a batch of texts and their draws."""
    units, parent, place, n = lines(texts)
    modulo = lambda a, b: pc.subtract(a, pc.multiply(pc.divide(a, b), b))
    cuts = [modulo(x, pc.add(n, 1)) for x in h[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    after_low, after_high = (pc.greater_equal(place, cut.take(parent)) for cut in (low, high))
    roles = [pc.invert(after_low), pc.and_(after_low, pc.invert(after_high)), after_high]
    prefix, middle, suffix = (_rebuilt(units, *x) for x in zip(roles, (low, pc.subtract(high, low), pc.subtract(n, high)), strict=True))
    marked = pc.equal(pc.binary_length(texts), 0)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    plain = pc.or_(marked, pc.greater_equal(modulo(h[2], pa.scalar(100, pa.int64())), percent))
    spm = pc.less(modulo(h[3], pa.scalar(100, pa.int64())), spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    psm_text, spm_text = _joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle), _joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    chars = lambda piece: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(piece).cast(pa.int64()))
    return {
        "n": n, "form": form.cast(pa.string()), "prefix_chars": chars(prefix), "middle_chars": chars(middle),
        "output": pc.if_else(plain, texts, pc.if_else(spm, spm_text, psm_text)),
    }


_MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _transform(percent: int, spm_percent: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends = in_bytes(batch.column("text"))
            for begin, end in slices(ends, size):
                part = batch.slice(begin, end - begin)
                made = transformed(part.column("text").cast(_TEXT), [part.column(f"h{i}") for i in range(1, 5)], percent, spm_percent)
                made["output"] = made["output"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc"), *made.values()], ["doc", *made])

    return run


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, percent: int = 100, spm_percent: int = 50, text: str = "text", doc_id: str = "doc_id", size: int = 8 << 20
) -> DataFrame:
    """Cut each whole text after two of its lines, drawn by the doc_id, and put the middle last.

    Returns ``doc`` (all columns of the document), ``n`` (lines), ``form``, ``prefix_chars`` and ``middle_chars`` (code points; null if plain) and
    ``output``: the text if plain, else ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm) or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm).
    Texts that are empty or hold one of the marks stay plain, and so do those that are not among ``percent`` of a hundred; ``spm_percent``
    of a hundred others are spm. A null text is empty, a null doc_id counts as an empty one. Rows are independent: repeated rows
    and rows that share a doc_id are drawn alike. An empty table gives no rows. Texts go through in slices of about ``size`` bytes, a longer one by itself.
    """
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = docs.select(F.struct("*").alias("doc"), whole, *(h.alias(f"h{i}") for i, h in enumerate(draws(F.col(doc_id), seed), 1)))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_transform(percent, spm_percent, size), f"doc {kind}, {_MADE}")


def _from(column: Column, place: Column | int) -> Column:
    """What follows so many bytes of a text."""
    return F.substring(column.cast("binary"), F.lit(place) + 1, F.octet_length(column)).cast("string")


def restore(rows: DataFrame) -> DataFrame:
    """The frame (which has ``form`` and ``output``) as ``row``, and ``restored``, the exact text that each output was made of, from these two alone.

    A text with a mark in it stays plain, and no two marks can overlap, so the first of each kind is the one that was put in. These are
    SQL functions, so that a task which makes the outputs feeds one Python worker, not a second one with the first one's rows.
    """
    form, first, second = F.col("form"), F.col("first"), F.col("second")
    cut = rows.select(F.struct("*").alias("row"), "form", "output")
    cut = cut.withColumn("first", F.when(form == "psm", F.substring_index("output", SUFFIX, 1)).when(form == "spm", F.substring_index("output", PREFIX, 1)))
    cut = cut.withColumn("rest", _from(F.col("output"), F.octet_length(first) + len(SUFFIX)))  # all marks are as long
    cut = cut.withColumn("second", F.substring_index("rest", MIDDLE, 1))
    one, middle = _from(first, len(PREFIX)), _from(F.col("rest"), F.octet_length(second) + len(MIDDLE))
    text = F.when(form == "plain", F.col("output")).when(form == "psm", F.concat(one, middle, second)).when(form == "spm", F.concat(second, middle, one))
    return cut.select("row", text.otherwise(F.raise_error(F.lit("a form is none of plain, psm and spm"))).alias("restored"))


ORACLE = r"""
WITH h AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), c AS (
    SELECT doc_id, t, u, len(u) AS n, [('0x' || x[8 * i + 1:8 * i + 8])::BIGINT FOR i IN range(4)] AS h FROM h
), p AS (
    SELECT doc_id, t, n,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(u[1:least(h[1] % (n + 1), h[2] % (n + 1))], '') AS prefix,
        array_to_string(u[least(h[1] % (n + 1), h[2] % (n + 1)) + 1:greatest(h[1] % (n + 1), h[2] % (n + 1))], '') AS middle,
        array_to_string(u[greatest(h[1] % (n + 1), h[2] % (n + 1)) + 1:], '') AS suffix
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
