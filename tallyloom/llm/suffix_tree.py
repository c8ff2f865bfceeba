"""Language-model scores from a probabilistic suffix tree over words.

The root holds add-one word probabilities. Deeper nodes are contexts, one or more preceding words, that occur at least
LEAST times in the training documents, so the tree grows with the corpus. A context stays in the tree if its next-word
distribution diverges from that of its longest shorter context by more than a threshold, measured with each occurrence
left out of its own estimate. Distributions are smoothed with the shorter context's. A text is scored from the longest
context of the tree at each word.

Counts are exact and cover all training documents. The tree is built level by level and never gathered: documents form
blocks; a block sends each of its different (context, word) pairs once, with count and the shorter context's probability,
to the context's shard, which sums them, decides on its contexts and answers with the corpus counts. A pair's count is
the number of occurrences of the context that is one word longer, so a block knows which contexts to ask for at the next
level. Below the third level few places are left: a block sends its state at these along, and the next level starts
from it instead of the texts (before, such states are larger than the texts). A context with over SPLIT occurrences is dealt over several shards by its next words, and its divergence summed
over these. So what a task holds grows with its block or shard, not with the corpus, and nothing of the tree is on the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, Hasher, in_blocks, kept, let_go, mixed, only, packed, steps, strings, unpacked, word_spans

#: Longest contexts, in words.
DEPTH = 3
#: Occurrences that a context has at least.
LEAST = 50
#: Weight of the shorter context's distribution, in occurrences.
PRIOR = 100.0
#: Divergence, in log10 units for each occurrence, from which a context stays.
DIVERGENCE = 0.01
#: Occurrences of a context for each of its shards.
SPLIT = 1 << 17
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
WORDS = Hasher(404)
WORDS.values = WORDS.values[LOWER]  # hashes of lower-cased words
#: Levels after this one can start from a state, and levels up to FROM_TEXTS do start from the texts.
FROM_STATE, FROM_TEXTS = 2, 3
#: Stands for a shard in the row that bears a block's state.
STATE = 1 << 62
END = np.uint64(0x1F3D5B79A2C4E687)
STEP = np.uint64(0x9E3779B97F4A7C15)

SENT = "block long, shard long, keys binary, counts binary, contexts binary, runs binary, totals binary, priors binary, train long"
ANSWERS = "block long, shard long, level int, counts binary, new long"


class Places:
    """Tokens and their places in their documents."""

    def __init__(self, token: np.ndarray, place: np.ndarray):
        self.token, self.place = token, place

    def contexts(self, depth: int, at: np.ndarray) -> np.ndarray:
        """Hash of the `depth` tokens before each of the given places."""
        h = np.zeros(len(at), np.uint64)
        for k in range(depth, 0, -1):
            h = mixed(h * STEP + self.token[at - k])
        return h


class Tokens(Places):
    """Word hashes of a block's documents, each document closed by END."""

    def __init__(self, texts: pa.Array):
        only()
        parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in steps(texts):
            starts, ends, first = word_spans(data, offsets)
            n = np.diff(first)
            token = np.full(len(starts) + len(n), END)
            token[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = WORDS.spans(data, starts, ends)
            parts.append(token)
            sizes.append(n + 1)
        self.sizes = np.concatenate(sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        token = np.concatenate(parts)
        kind = np.int32 if len(token) < 1 << 31 else np.int64
        place = np.arange(len(token), dtype=kind)
        place -= np.repeat(self.first.astype(kind), self.sizes)
        super().__init__(token, place)


def ordered(key: np.ndarray) -> np.ndarray:
    """Order of hashes by their leading bits, as many as fit beside their numbers in one sorted integer; then by number."""
    low = np.uint64((1 << max(1, len(key) - 1).bit_length()) - 1)
    order = key & ~low
    order |= np.arange(len(key), dtype=np.uint64)
    order.sort()
    order &= low
    return order.view(np.int64)


def different(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, a place of each, and the number of each entry's value."""
    order = ordered(key)
    there = key[order]
    new = np.ones(len(key), bool)
    new[1:] = there[1:] != there[:-1]
    run = there >> np.uint64(max(1, len(key) - 1).bit_length())
    mixed_up = new.copy()  # another value than before, but not another run of leading bits
    mixed_up[1:] &= run[1:] == run[:-1]
    if len(key) and mixed_up[1:].any():
        at = np.flatnonzero(np.isin(run, run[1:][mixed_up[1:]]))
        right = np.argsort(there[at], kind="stable")
        order[at], there[at] = order[at[right]], there[at[right]]
        new[1:] = there[1:] != there[:-1]
    del run, mixed_up
    number = np.empty(len(key), np.int32 if len(key) < 1 << 31 else np.int64)
    number[order] = np.cumsum(new, dtype=number.dtype) - number.dtype.type(1)
    return there[new], order[new], number


@dataclass(frozen=True)
class Rules:
    shards: int
    least: int
    prior: float
    divergence: float
    split: int
    n_train: int = 0
    n_words: int = 0


class Asked:
    """The different (context, token) pairs at the given places of a block, ordered by shard and context."""

    def __init__(self, t: Places, level: int, at: np.ndarray, total: np.ndarray, rules: Rules):
        token = t.token[at]
        if level:
            context = t.contexts(level, at)
            token = mixed(context * STEP + token)
        self.key, one, number = different(token)
        del token
        self.total, self.one = total[one], at[one]
        self.context = context[one] if level else self.key
        context = one = None
        shards = np.uint64(rules.shards)
        if level:
            parts = (self.total // rules.split + 1).astype(np.uint64)
            self.shard = (mixed(self.context) % shards + mixed(self.key) % parts) % shards
            self.shard[parts > 1] += shards  # contexts dealt over several have shards of their own
            bits = (2 * rules.shards).bit_length()  # then as many of the context as there is room for
            order = ordered((self.shard << np.uint64(64 - bits)) | (self.context >> np.uint64(bits)))
        else:
            self.shard = self.key % shards
            order = np.argsort(self.shard, kind="stable")
        for name in ("key", "total", "one", "shard"):
            setattr(self, name, getattr(self, name)[order])
        self.context = self.context[order] if level else self.key
        rank = np.empty(len(order), number.dtype)
        rank[order] = np.arange(len(order), dtype=number.dtype)
        self.inverse = rank[number]


class Walk:
    """A block's tokens, level by level: probability of each token, and occurrences of the next longer context before it."""

    def __init__(self, t: Places, train: np.ndarray, rules: Rules):
        self.t, self.train, self.rules = t, train, rules
        n = len(t.token)
        self.p, self.deep, self.level = np.zeros(n), np.zeros(n, bool), 0
        self.at, self.total = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64), np.zeros(n, np.int64)

    @classmethod
    def of_texts(cls, part: pa.Table, rules: Rules) -> Walk:
        t = Tokens(strings(part.column("text")))
        return cls(t, np.repeat(~part.column("held").to_numpy(zero_copy_only=False), t.sizes), rules)

    @classmethod
    def of_state(cls, part: pa.Table, level: int, rules: Rules) -> Walk:
        """The walk at a level, from what state() has packed there; scores can't be taken from it."""
        only()
        walk = cls(Places(unpacked(part.column("keys")), unpacked(part.column("counts"), np.int32)), unpacked(part.column("priors"), bool), rules)
        walk.p, walk.level = unpacked(part.column("contexts"), np.float64).copy(), level
        walk.at, walk.total = unpacked(part.column("runs"), np.uint32).astype(np.int64), unpacked(part.column("totals"), np.int64)
        return walk

    def state(self, depth: int) -> tuple[bytes, ...]:
        """The walk at the places still asked for, with the tokens before them and those that deeper levels come to."""
        use = np.zeros(len(self.t.token) + 1, np.int64)
        np.add.at(use, self.at - self.level, 1)
        np.add.at(use, np.minimum(self.at + depth - self.level, len(self.t.token) - 1) + 1, -1)
        use = np.cumsum(use[:-1]) > 0
        at = (np.cumsum(use) - 1)[self.at]
        return tuple(packed(x) for x in (self.t.token[use], self.t.place[use].astype(np.int32), self.p[use], at.astype(np.uint32), self.total, self.train[use]))

    def ask(self) -> Asked:
        return Asked(self.t, self.level, self.at, self.total, self.rules)

    def take(self, answers: pa.Table) -> None:
        """Goes one level on with the shards' answers to what was asked."""
        here = answers.filter(pc.equal(answers.column("level"), self.level)).sort_by("shard")
        said = unpacked(here.column("counts"), np.int64)[self.ask().inverse]
        if self.level:
            c, stays = said >> 1, (said & 1).astype(bool)
            at, total = self.at[stays], self.total[stays]
            self.p[at] = (c[stays] + self.rules.prior * self.p[at]) / (total + self.rules.prior)
            self.deep[at] = True
        else:
            c = said
            self.p = (c + 1) / (self.rules.n_train + self.rules.n_words + 1)
            self.base, self.known = self.p.copy(), c > 0
        self.level += 1
        # a counted pair is the context, one word longer, of the token behind it
        behind = np.minimum(self.at + 1, max(0, len(self.t.place) - 1))
        use = (c >= self.rules.least) & (self.t.place[behind] >= self.level) & (behind > self.at)
        self.at, self.total = behind[use], c[use]


def told(walk: Walk, block: int, depth: int = 0) -> pa.Table:
    """What a block sends at its level: one row for each shard, and its state as shard STATE if the next level starts from it."""
    asked, level = walk.ask(), walk.level
    count = np.bincount(asked.inverse, walk.train[walk.at], len(asked.key)).astype(np.int64)
    prior = walk.p[asked.one].astype(np.float32)  # for the decision alone: scores take the block's own
    numbers, first = np.unique(asked.shard, return_index=True)
    cuts, rows = np.append(first, len(asked.key)), []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        new = np.ones(b - a, bool)
        new[1:] = asked.context[a + 1 : b] != asked.context[a : b - 1]
        heads = np.flatnonzero(new)
        runs = np.diff(np.append(heads, b - a)).astype(np.uint32)
        rows.append((packed(short(walk.t.token[asked.one[a:b]])) if level else packed(asked.key[a:b]), packed(count[a:b].astype(np.uint32)), *((packed(asked.context[a:b][heads]), packed(runs), packed(asked.total[a:b][heads]), packed(prior[a:b])) if level else (b"",) * 4), int(count[a:b].sum())))
    if FROM_STATE < level + 1 <= depth and len(walk.at):
        numbers = np.append(numbers, np.uint64(STATE))
        rows.append((*walk.state(depth), 0))
    columns = list(zip(*rows, strict=True)) or [()] * 7
    kinds = [pa.binary()] * 6 + [pa.int64()]
    names = [c.split()[0] for c in SENT.split(", ")]
    return pa.table([pa.array([block] * len(rows), pa.int64()), pa.array(numbers.astype(np.int64)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)


def short(token: np.ndarray) -> np.ndarray:
    """The low six bytes of word hashes, which tell the next words of one context apart."""
    return token.view(np.uint8).reshape(-1, 8)[:, :6]


def long(column: pa.ChunkedArray) -> np.ndarray:
    """Six-byte hashes as integers."""
    six = unpacked(column, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.reshape(-1).view(np.uint64)


class Shard:
    """The pairs that blocks have sent to one shard, summed."""

    def __init__(self, part: pa.Table, level: int, rules: Rules):
        self.sizes = [len(x) // 4 for x in part.column("counts").to_pylist()]
        if level:
            context = np.repeat(unpacked(part.column("contexts")), unpacked(part.column("runs"), np.uint32))
            key = mixed(context * STEP + long(part.column("keys")))
        else:
            key = unpacked(part.column("keys"))
        _, one, self.inverse = different(key)
        self.c = np.zeros(len(one), np.int64)
        np.add.at(self.c, self.inverse, unpacked(part.column("counts"), np.uint32))
        if not level:
            return
        context = context[one]
        total = np.repeat(unpacked(part.column("totals"), np.int64), unpacked(part.column("runs"), np.uint32))[one]
        p = unpacked(part.column("priors"), np.float32)[one].astype(np.float64)
        left_out = (self.c - 1 + rules.prior * p) / (total - 1 + rules.prior)
        gain = np.zeros(len(p))
        seen = self.c > 0
        gain[seen] = self.c[seen] * np.log10(left_out[seen] / p[seen])
        self.contexts, first, self.node = different(context)
        self.totals, self.gains = total[first], np.bincount(self.node, gain, len(self.contexts))

    def answers(self, part: pa.Table, level: int, said: np.ndarray) -> pa.Table:
        cuts = np.append(0, np.cumsum(self.sizes))
        said = said[self.inverse]
        counts = [packed(said[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        new = [0 if level else int((self.c > 0).sum())] + [0] * (len(counts) - 1)
        return pa.table([part.column("block"), part.column("shard"), pa.array([level] * len(counts), pa.int32()), pa.array(counts, pa.binary()), pa.array(new, pa.int64())], names=["block", "shard", "level", "counts", "new"])


def score_documents(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, prior: float = PRIOR, divergence: float = DIVERGENCE, block_bytes: int = BLOCK_BYTES, split: int = SPLIT) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_deep.

    The model learns from documents whose crc32(doc_id as text) modulo 7 is not 2 (null ids: learned from). Null text
    counts as empty, which is the end token alone. n_deep counts tokens scored from a context, not from the root.
    Repeated rows are documents like others; a very long text is one block's, as it is; without training documents all
    probabilities are those of an unknown word; an empty table gives an empty result; further columns are not read.
    """
    rows, _, size = in_blocks(docs, ["doc_id", "text"], block_bytes)
    rows = rows.withColumn("held", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)))
    text = rows.select("block", "text", "held")
    rules = Rules(max(64, size // SHARD_BYTES), least, prior, divergence, split)

    def walked(part: pa.Table, back: pa.Table, levels: int, rules: Rules) -> Walk:
        walk = Walk.of_texts(part, rules)
        for _ in range(levels):
            walk.take(back)
        return walk

    def sender(level: int, rules: Rules):
        if not level:
            return lambda part: told(Walk.of_texts(part, rules), part.column("block")[0].as_py())
        if level <= FROM_TEXTS:
            return lambda part, back: told(walked(part, back, level, rules), part.column("block")[0].as_py(), depth if level == FROM_TEXTS else 0)

        def run(part: pa.Table, back: pa.Table) -> pa.Table:
            if not len(part):
                return part
            walk = Walk.of_state(part, level - 1, rules)
            walk.take(back)
            return told(walk, part.column("block")[0].as_py(), depth)

        return run

    def counter(level: int, rules: Rules):
        """Answers of a shard; of contexts dealt over several shards, those that stay come from `staying`."""

        def run(part: pa.Table, staying: pa.Table) -> pa.Table:
            only()
            if not len(part):
                return pa.table([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())], names=["block", "shard", "level", "counts", "new"])
            shard = Shard(part, level, rules)
            said = shard.c
            if level:
                if part.column("shard")[0].as_py() < rules.shards:
                    stays = shard.gains > rules.divergence * shard.totals
                else:
                    stays = np.isin(shard.contexts, staying.column("context").to_numpy().astype(np.int64).view(np.uint64))
                stays = stays[shard.node]
                said = np.where(stays | (shard.c >= rules.least), shard.c * 2 + stays, 0)
            return shard.answers(part, level, said)

        return run

    def gains(level: int, rules: Rules):
        def run(part: pa.Table) -> pa.Table:
            only()
            shard = Shard(part, level, rules)
            n = len(shard.contexts)
            return pa.table([pa.array([part.column("shard")[0].as_py()] * n, pa.int64()), pa.array(shard.contexts.view(np.int64)), pa.array(shard.totals), pa.array(shard.gains)], names=["shard", "context", "total", "gain"])

        return run

    back, answers, states, level = None, None, None, 0
    while level <= depth:
        if level > FROM_TEXTS:
            sent = states.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sender(level, rules), SENT)
        elif level:
            sent = text.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(sender(level, rules), SENT)
        else:
            sent = text.groupBy("block").applyInArrow(sender(level, rules), SENT)
        whole = kept(sent, f"suffix-{level}")
        if states is not None:
            let_go(states)
        sent, states = whole.filter(F.col("shard") != STATE), whole.filter(F.col("shard") == STATE) if FROM_TEXTS < level + 1 <= depth else None
        if sent.isEmpty():
            let_go(whole)
            break
        parts = kept(sent.filter(F.col("shard") >= rules.shards).groupBy("shard").applyInArrow(gains(level, rules), "shard long, context long, total long, gain double"), "suffix-gains") if level else None
        if level:
            stay = parts.groupBy("context").agg(F.sum("gain").alias("gain"), F.max("total").alias("total")).filter(F.col("gain") > divergence * F.col("total"))
            staying = parts.join(stay.select("context"), "context", "left_semi").select("shard", "context")
        else:
            staying = sent.sparkSession.createDataFrame([], "shard long, context long")
        answers = kept(sent.groupBy("shard").cogroup(staying.groupBy("shard")).applyInArrow(counter(level, rules), ANSWERS), "suffix-answers")
        if not level:
            rules = Rules(rules.shards, least, prior, divergence, split, int(sent.agg(F.sum("train")).first()[0] or 0), int(answers.agg(F.sum("new")).first()[0] or 0))
        else:
            let_go(parts)
        if states is None:
            let_go(whole)
        back = answers if back is None else back.unionByName(answers)
        level += 1
    levels = level

    def score(part: pa.Table, back: pa.Table) -> pa.Table:
        walk = walked(part, back, levels, rules)
        t = walk.t
        add = lambda x, kind: pa.array(np.add.reduceat(x, t.first) if len(t.first) else x, kind)
        return pa.table([part.column("doc_id").cast(pa.int64()), part.column("held"), pa.array(t.sizes, pa.int64()), add(walk.known.astype(np.int64), pa.int64()), pa.array([rules.n_train] * len(t.sizes), pa.int64()), add(np.log10(walk.base), pa.float64()), add(np.log10(walk.p), pa.float64()), add(walk.deep.astype(np.int64), pa.int64())], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_deep"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_deep long"
    if back is None:
        return docs.sparkSession.createDataFrame([], schema)
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(score, schema)
