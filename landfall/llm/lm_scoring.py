"""Language-model scores by a weighted backoff automaton.

A state of the automaton is a context of up to ``order - 1`` tokens seen in training, the empty one included. From a state, each n-gram seen
is an arc with its smoothed probability; for other tokens a failure arc leads to the context without its first token, at the weight that the
smoothing leaves for it. Scoring a text is one pass from left to right that carries the state: take failure arcs until the token has an arc, add
up the weights, go to the longest context that ends with the token.

Smoothing puts ``strength`` pseudo-counts of the shorter context's model on each context:
p(w | h) = (c(h w) + strength * p(w | h')) / (c(h) + strength), and p(w) = (c(w) + 1) / (N + V + 1) at the root.

No task holds the model. Texts are dealt over blocks. Each block names its n-grams once, with their counts in its training texts; the counts
are added up by n-gram, and every block gets back the totals of its own n-grams: the part of the automaton that its texts can visit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, mixed

_END = np.uint64(0x5851F42D4C957F2D)
_TAGS = np.uint64(3)


def tokens(texts: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word and for the end of each text; number of tokens by text."""
    parts, sizes = [], []
    for text in texts:
        words = text.encode().lower().split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        parts.append(np.array([_END]))
        sizes.append(len(words) + 1)
    return np.concatenate(parts), np.array(sizes)


def ngrams(hashes: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each n the name of the n-gram that ends at each token; 0 where it would begin before the text. The two low bits say n."""
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [mixed(hashes) & ~_TAGS | np.uint64(1)]
    for n in range(2, order + 1):
        name = np.zeros(len(hashes), np.uint64)
        name[1:] = mixed(out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + mixed(hashes[1:])) & ~_TAGS | np.uint64(n)
        name[place < n - 1] = 0
        out.append(name)
    return out


def packed(values: np.ndarray) -> bytes:
    """Counts, most of them small: a byte each, and those from 255 on in full behind them."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype(np.int64).tobytes()


def unpacked(content: bytes, n: int) -> np.ndarray:
    values = np.frombuffer(content, np.uint8, n).astype(np.int64)
    values[values == 255] = np.frombuffer(content, np.int64, offset=n) if len(content) > n else 0
    return values


class Block:
    """The n-grams of some texts: their names in order, and where each token's are."""

    def __init__(self, texts, learn: np.ndarray, order: int):
        hashes, self.sizes = tokens(texts)
        grams = ngrams(hashes, self.sizes, order)
        used = [g != 0 for g in grams]
        self.names, at = np.unique(np.concatenate([g[u] for g, u in zip(grams, used)]), return_inverse=True)
        self.at = []
        for u in used:
            place = np.full(len(hashes), -1)
            place[u], at = at[: u.sum()], at[u.sum() :]
            self.at.append(place)
        self.learn = learn

    def counts(self) -> np.ndarray:
        """How often each n-gram occurs in the training texts."""
        taught = np.repeat(self.learn, self.sizes)
        total = np.zeros(len(self.names), np.int64)
        for place in self.at:
            total += np.bincount(place[taught & (place >= 0)], minlength=len(total))
        return total

    def cuts(self, buckets: int) -> np.ndarray:
        """Where the names of each bucket begin: buckets are equal ranges of names."""
        edges = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)
        return np.append(np.searchsorted(self.names, edges), len(self.names))

    def by_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)


class Automaton:
    """The states and arcs that a block's texts can visit; arcs are named by their n-gram, states by that of their context, the root comes last.

    ``fail`` and ``fail_weight`` are each state's failure arc, ``seen``, ``arc_weight`` and ``goto`` tell whether an n-gram is an arc of its context's
    state, its log10 probability and the state that it leads to. A word never seen is an arc of the root that leads back to it.
    """

    def __init__(self, block: Block, totals: np.ndarray, tokens_: int, types: int, strength: float):
        order, self.root = len(block.at), len(totals)
        prefix, suffix = np.full(self.root, self.root), np.full(self.root, self.root)
        self.length = np.append((block.names & _TAGS).astype(np.int64), 0)
        for n in range(1, order):
            ends = np.flatnonzero(block.at[n] >= 0)
            prefix[block.at[n][ends]] = block.at[n - 1][ends - 1]
            suffix[block.at[n][ends]] = block.at[n - 1][ends]
        p = (totals + 1.0) / (tokens_ + types + 1.0)
        for n in range(2, order + 1):
            long = np.flatnonzero(self.length == n)
            p[long] = (totals[long] + strength * p[suffix[long]]) / (totals[prefix[long]] + strength)
        self.seen = (totals > 0) | (self.length[:-1] == 1)
        self.arc_weight = np.log10(p)
        self.fail = np.append(suffix, self.root)
        self.fail_weight = np.append(np.log10(strength / (totals + strength)), 0.0)
        self.goto = np.where(totals == 0, self.root, np.where(self.length[:-1] < order, np.arange(self.root), suffix))


def pieces_of(sizes: np.ndarray, most: int, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in pieces of at most ``most`` tokens: where each is entered, where it begins and ends; those with the longest way come first.

    A piece is entered up to ``ahead`` tokens before it begins. A state tells no more than that many tokens, so it is the text's own by then.
    """
    counts = -(-sizes // most)
    text_begin = np.repeat(np.cumsum(sizes) - sizes, counts)
    begin = text_begin + most * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    end = np.minimum(begin + most, text_begin + np.repeat(sizes, counts))
    enter = np.maximum(begin - ahead, text_begin)
    by_way = np.argsort(enter - end, kind="stable")
    return enter[by_way], begin[by_way], end[by_way]


def traverse(block: Block, model: Automaton, most: int = 256) -> np.ndarray:
    """The log10 weight of each token: one pass from left to right that carries a state for each piece of text, all pieces of the block side by side."""
    arcs, weight = np.stack(block.at), np.zeros(len(block.at[0]))
    enter, begin, end = pieces_of(block.sizes, most, len(block.at) - 1)
    state = np.full(len(enter), model.root)
    for step in range(int((end - enter).max(initial=0))):
        going = int(np.searchsorted(enter - end, -step, side="left"))
        state, place = state[:going], enter[:going] + step
        arc, paid = arcs[model.length[state], place], np.zeros(going)
        while len(stuck := np.flatnonzero(~model.seen[arc])):
            paid[stuck] += model.fail_weight[state[stuck]]
            state[stuck] = model.fail[state[stuck]]
            arc[stuck] = arcs[model.length[state[stuck]], place[stuck]]
        own = place >= begin[:going]
        weight[place[own]] = (paid + model.arc_weight[arc])[own]
        state = model.goto[arc]
    return weight


def _name(order: int, buckets: int):
    """Per block and bucket: the n-grams' names and counts."""

    def run(table: pa.Table) -> pa.Table:
        block = Block((t.as_py() for t in table.column("text")), table.column("learn").to_numpy(), order)
        counts, cuts = block.counts(), block.cuts(buckets)
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        pack = lambda x, f: pa.array([f(x[cuts[b] : cuts[b + 1]]) for b in full], pa.binary())
        number = table.column("block")[0].as_py()
        return pa.table({"block": pa.array([number] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()), "names": pack(block.names, np.ndarray.tobytes), "counts": pack(counts, packed)})

    return run


def _total(table: pa.Table) -> pa.Table:
    """Add up the counts of a bucket and give each block the totals of its names; the bucket's tokens and types go with one of the rows."""
    names = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("names")]
    counts = np.concatenate([unpacked(x.as_py(), len(n)) for x, n in zip(table.column("counts"), names)])
    distinct, at = np.unique(np.concatenate(names), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, counts)
    words = total[distinct & _TAGS == 1]
    ends = np.cumsum([len(x) for x in names])
    replies = [packed(x) for x in np.split(total[at], ends[:-1])]
    only_first = lambda n: pa.array([int(n)] + [0] * (len(replies) - 1), pa.int64())
    return pa.table({
        "block": table.column("block"), "bucket": table.column("bucket"), "checksum": pa.array([int(np.bitwise_xor.reduce(x).view(np.int64)) for x in names], pa.int64()), "totals": pa.array(replies, pa.binary()), "tokens": only_first(words.sum()), "types": only_first((words > 0).sum()),
    })


def _score(order: int, strength: float, buckets: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({n: docs.column(n) for n in ("doc_id", "learn")} | {n: pa.array([], t) for n, t in _OUT})
        block = Block((t.as_py() for t in docs.column("text")), docs.column("learn").to_numpy(), order)
        cuts, totals = block.cuts(buckets), np.zeros(len(block.names), np.int64)
        for b, reply, checksum in zip(replies.column("bucket").to_pylist(), replies.column("totals"), replies.column("checksum").to_pylist()):
            if int(checksum) != int(np.bitwise_xor.reduce(block.names[cuts[b] : cuts[b + 1]]).view(np.int64)):
                raise RuntimeError("a block's texts have changed since their n-grams were counted")
            totals[cuts[b] : cuts[b + 1]] = unpacked(reply.as_py(), cuts[b + 1] - cuts[b])
        n, v = (replies.column("all")[0].as_py()[c] for c in ("tokens", "types"))
        known = totals[block.at[0]]
        base = np.log10((known + 1.0) / (n + v + 1.0))
        values = (
            block.sizes, block.by_text((known > 0).astype(np.int64)), np.full(len(docs), n), block.by_text(base),
            block.by_text(traverse(block, Automaton(block, totals, n, v, strength))),
        )
        return pa.table({n: docs.column(n) for n in ("doc_id", "learn")} | {n: pa.array(x, t) for (n, t), x in zip(_OUT, values)})

    return run


_OUT = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def score_texts(
    docs: DataFrame, learn: Column, order: int = 2, strength: float = 200.0, block_bytes: int = 6 << 20, blocks_a_bucket: int = 3, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Learn from the documents where ``learn`` is true and score every whole text.

    Returns one row per document: doc_id, learn, n_tokens (words and one end), n_known (tokens seen in training), train_tokens, base_score (of
    the root state alone) and score, both the log10 probability of all tokens. Null texts count as empty and have the end only; a null
    ``learn`` counts as false. Repeated rows count as often as they occur. Other columns are not looked at; an empty table gives no rows.
    Without training documents each token has probability 1. Texts are dealt over blocks of about ``block_bytes``; the n-grams of as much text as
    ``blocks_a_bucket`` blocks hold are added up in one task, in a row per block and bucket, never more rows than n-grams.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be from 1 to 3")
    rows = keyed(docs, F.coalesce(learn, F.lit(False)).alias("learn"), text=text, doc_id=doc_id)
    size = rows.agg(F.sum(F.octet_length("text") + 1)).head()[0] or 0
    n = size // block_bytes + 1
    buckets = -(-n // blocks_a_bucket)
    # Copies of a row are spread by their place. It is the same wherever the plan reads the documents, and the sums below prove it.
    blocks = rows.select(F.pmod(F.xxhash64("k", "c", F.spark_partition_id()), F.lit(n)).cast("int").alias("block"), "doc_id", "learn", "text")
    named = blocks.groupBy("block").applyInArrow(_name(order, buckets), "block int, bucket int, names binary, counts binary")
    replies = named.groupBy("bucket").applyInArrow(_total, "block int, bucket int, checksum long, totals binary, tokens long, types long")
    sums = replies.agg(F.struct(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types")).alias("all"))
    replies = replies.withColumn("all", sums.scalar())
    kind = docs.schema[doc_id].dataType.simpleString()
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _score(order, strength, buckets), f"doc_id {kind}, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
