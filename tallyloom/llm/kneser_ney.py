"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of each language's trusted text.

Symbols are the UTF-8 bytes of a text's words, one space between words, and a word that repeats the one before it is a
symbol of its own, space and all: trusted text rarely repeats words, so repetition is as improbable as strange characters are. Counts
of all orders, context sums and the interpolation down the orders are grouped and joined by n-gram, which Spark shards
by hash. Scoring is joins too: a block of documents asks once for each of its different n-grams, these meet the tables
order by order, and one value for each goes back to the block, which adds up its documents. No table is gathered.
The model counts all trusted documents of a language; perplexities and quantiles cover all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Hasher, in_blocks, joined_words, kept, let_go, mixed, only, steps, strings, word_spans

ORDER = 5
#: Parts in which a language's trusted ids are ranked first, if only some are asked for.
PARTS = 64
#: Different grams that a task holds of a language before it hands them on.
HELD_GRAMS = 1 << 21
#: Text bytes of a block of documents, about.
BLOCK_BYTES = 32 << 20
#: Share of a language's trusted documents that the threshold lets through.
QUANTILE = 0.998
#: Fewer trusted documents than this: the threshold of all languages.
LEAST_TRUSTED = 30
ANY = "*"
AGAIN, BEGIN, END = 1, 2, 3
WORDS = Hasher(505)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some rows and their offsets: ORDER - 1 begins, the words, an end."""
    starts, ends, first = word_spans(data, offsets)
    h = WORDS.spans(data, starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    heads = first[:-1]
    again[heads[heads < len(h)]] = False
    data = data.copy()
    data[starts[again]] = AGAIN
    out, _, new_ends = joined_words(data, starts, np.where(again, starts + 1, ends))
    cuts = np.concatenate([[0], new_ends + 1])[first]  # each word has a space after it
    dropped = new_ends[:-1][again[1:]]  # a repeated word's symbol stands for the space before it as well
    out, cuts = np.delete(out, dropped), cuts - np.searchsorted(dropped, cuts)
    n = len(cuts) - 1
    sizes = np.diff(cuts) + ORDER
    at = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.full(int(at[-1]), BEGIN, np.uint8)
    body = np.arange(len(out)) + np.repeat(ORDER * np.arange(n) + ORDER - 1, np.diff(cuts))
    whole[body] = out
    whole[at[1:] - 1] = END
    return whole, at


def grams(whole: np.ndarray, order: int) -> np.ndarray:
    """The code of the `order` symbols that end at each place, the last symbol in the low byte (before the first: zeros)."""
    code = np.zeros(len(whole), np.uint64)
    wide = whole.astype(np.uint64)
    for k in range(order):
        code[k:] |= wide[: len(whole) - k] << np.uint64(8 * k)
    return code


def counted(whole: np.ndarray, at: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of some rows' symbols, sorted, and how often each is there."""
    real = np.ones(len(whole), bool)
    for k in range(order - 1):
        real[at[:-1] + k] = False
    return np.unique(grams(whole, order)[real], return_counts=True)


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of the highest order, from (lang, text)."""

    def rows(lang: str, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        codes, n = summed(held)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist(), object), strings(b.column(1))
            for lang in sorted(set(langs)):
                mine = held.setdefault(lang, [])
                for _, _, data, offsets in steps(texts.take(pa.array(np.flatnonzero(langs == lang)))):
                    mine.append(counted(*symbols(data, offsets), order))
                    if sum(len(codes) for codes, _ in mine) > HELD_GRAMS:
                        mine[:] = [summed(mine)]
                        if len(mine[0][0]) > HELD_GRAMS // 2:
                            yield rows(lang, mine)
                            mine.clear()
        for lang, mine in held.items():
            if mine:
                yield rows(lang, mine)

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several steps as one."""
    codes, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def suffix(gram: Column, order: int) -> Column:
    """A gram of `order` symbols without its first."""
    return gram.bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1))


def fitted(counts: DataFrame, order: int = ORDER) -> dict[str, DataFrame]:
    """Tables (lang, gram, value) by kind: log10 probabilities p1 to pORDER, and log10 weights g0 to gORDER-1 of shorter contexts."""
    named = lambda t, k: kept(t.withColumn("context", F.shiftright("gram", 8)), f"kn-counts-{k}")
    tables = {order: named(counts, order)}
    for k in range(order - 1, 0, -1):  # continuation counts: in how many different contexts an n-gram follows
        tables[k] = named(tables[k + 1].groupBy("lang", suffix(F.col("gram"), k + 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")), k)
    out: dict[str, DataFrame] = {}
    lower = None
    for k in range(1, order + 1):
        t = tables[k]
        of = t.groupBy("lang").agg(*(F.sum((F.col("n") == i).cast("double")).alias(f"t{i}") for i in range(1, 5)))
        y = F.coalesce(F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2")), F.lit(0.5))
        d = [F.when(F.col(f"t{i}") > 0, F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), i - (i + 1) * y * F.col(f"t{i + 1}") / F.col(f"t{i}")))).otherwise(0.5) for i in (1, 2, 3)]
        of = kept(of.select("lang", *(x.alias(f"d{i + 1}") for i, x in enumerate(d))), f"kn-discounts-{k}")  # its size is known to the join
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = t.join(of, "lang")
        sums = t.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum(discount).alias("taken"))
        joined = t.join(sums, ["lang", "context"])
        joined = joined.select("lang", "gram", suffix(F.col("gram"), k).alias("rest"), ((F.col("n") - discount) / F.col("total")).alias("own"), (F.col("taken") / F.col("total")).alias("weight"))
        if lower is None:
            p = joined.select("lang", "gram", (F.col("own") + F.col("weight") / 256).alias("p"))
        else:
            below = lower.select("lang", F.col("gram").alias("rest"), F.col("p").alias("below"))
            p = joined.join(below, ["lang", "rest"]).select("lang", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
        lower = kept(p, f"kn-p{k}")
        out[f"p{k}"] = lower.select("lang", "gram", F.log10("p").alias("value"))
        out[f"g{k - 1}"] = kept(sums.select("lang", F.col("context").alias("gram"), F.log10(F.col("taken") / F.col("total")).alias("value")), f"kn-g{k - 1}")
        let_go(tables[k])
    return out


def trained_models(texts: DataFrame, overall: bool = True) -> dict[str, DataFrame]:
    """Tables of the texts' languages and, if asked for, of all (ANY), from (lang, text)."""
    counts = kept(gram_counts(texts), "kn-counts")
    whole = counts
    if overall:  # each text once, whatever its language
        whole = counts.filter(F.col("lang") != ANY).unionByName(counts.groupBy("gram").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(ANY)))
    out = fitted(whole)
    let_go(counts)
    return out


def gram_logs(wanted: DataFrame, models: dict[str, DataFrame], order: int = ORDER) -> DataFrame:
    """(lang, gram, value): log10 probability of each wanted gram's last symbol after the others.

    Looked up in the highest order first; what an order lacks asks the next lower one for its different suffixes, and
    takes their value and the weight of its context. So few grams go through the lower orders.
    """
    looked = {}
    for k in range(order, 0, -1):
        looked[k] = kept(wanted.join(models[f"p{k}"], ["lang", "gram"], "left"), f"kn-looked-{k}")
        missed = looked[k].filter("value is null").select("lang", "gram", F.shiftright("gram", 8).alias("context"), suffix(F.col("gram"), k).alias("rest"))
        looked[k] = looked[k].filter("value is not null"), missed
        wanted = missed.select("lang", F.col("rest").alias("gram")).distinct()
    out = wanted.withColumn("value", F.lit(-math.log10(256)))
    for k in range(1, order + 1):
        found, missed = looked[k]
        weights = models[f"g{k - 1}"].select("lang", F.col("gram").alias("context"), F.col("value").alias("weight"))
        below = out.select("lang", F.col("gram").alias("rest"), F.col("value").alias("below"))
        value = F.coalesce("weight", F.lit(0.0)) + F.col("below")
        out = found.unionByName(missed.join(weights, ["lang", "context"], "left").join(below, ["lang", "rest"]).select("lang", "gram", value.alias("value")))
    logs = kept(out.select("lang", "gram", F.col("value").cast("float").alias("value")), "kn-logs")
    for found, _ in looked.values():
        let_go(found)
    return logs


class Lookup:
    """A hash table from n-gram codes to values, in numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, hashed: bool = False):
        self.hashed = hashed  # keys are hashes already
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, ~np.uint64(0))
        self.values = np.zeros(1 << self.bits, np.float32)
        todo, slot = np.arange(len(keys)), self.slots(keys)
        while len(todo):
            free = self.keys[slot] == ~np.uint64(0)
            _, one = np.unique(slot[free], return_index=True)
            took = np.flatnonzero(free)[one]
            self.keys[slot[took]] = keys[todo[took]]
            self.values[slot[took]] = values[todo[took]]
            left = np.ones(len(todo), bool)
            left[took] = False
            todo, slot = todo[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys if self.hashed else mixed(keys)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none) and whether there is one."""
        slot = self.slots(keys)
        there = self.keys[slot]
        found = there == keys
        out = np.where(found, self.values[slot], np.float32(0))
        todo = np.flatnonzero(~found & (there != ~np.uint64(0)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            found[todo[hit]] = True
            todo = todo[~hit & (there != ~np.uint64(0))]
        return out, found


def trusted_sample(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> DataFrame:
    """(lang, text) of trusted documents: quality 1 and not toxic. All of them, or for each language `rows`, with the least hash of doc_id."""
    trusted = trusted_ids(labels)
    if rows is None:
        return docs.join(trusted, "doc_id", "left_semi").select(F.coalesce("lang", F.lit(ANY)).alias("lang"), "text")
    named = docs.select("doc_id", F.coalesce("lang", F.lit(ANY)).alias("lang")).join(trusted, "doc_id", "left_semi").distinct()
    least = lambda *keys: F.row_number().over(Window.partitionBy("lang", *keys).orderBy(F.xxhash64("doc_id"), "doc_id"))
    # first within each of PARTS parts of a language, so that the task of its last choice sees at most rows * PARTS ids
    some = named.withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS))).withColumn("place", least("part")).filter(F.col("place") <= rows)
    ids = some.withColumn("place", least()).filter(F.col("place") <= rows).select("doc_id")
    chosen = docs.join(kept(ids, "kn-sample"), "doc_id", "left_semi")
    return chosen.select(F.coalesce("lang", F.lit(ANY)).alias("lang"), "text")


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").filter("doc_id is not null").distinct()


def row_key(docs: DataFrame) -> Column:
    """What tells a document from those with other ids, texts or languages, nulls included."""
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "text", "lang")), *(F.col(c).isNull() for c in ("doc_id", "text", "lang")))


def perplexities(docs: DataFrame, models: dict[str, DataFrame], id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity, row_key) of each row; languages without a model take that of all."""
    known = kept(models["g0"].select(F.col("lang").alias("model")).distinct(), "kn-languages")
    other = F.lit(None).cast("string") if known.isEmpty() else F.lit(ANY)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "lang", "text", row_key(docs).alias("row_key"))
    rows = rows.join(known, rows.lang == known.model, "left").withColumn("model", F.coalesce("model", other))
    blocked, _, _ = in_blocks(rows, ["doc_id", "lang", "text", "row_key", "model"], block_bytes)

    def by_model(part: pa.Table) -> Iterator[tuple[str | None, np.ndarray, np.ndarray, np.ndarray]]:
        """Steps of the rows that share a model: its name, the rows' places, symbols and offsets."""
        only()
        names, texts = np.array(part.column("model").to_pylist(), object), strings(part.column("text"))
        for name in sorted(set(names), key=lambda x: x or ""):
            places = np.flatnonzero(names == name)
            for first, end, data, offsets in steps(texts.take(pa.array(places))):
                yield name, places[first:end], *symbols(data, offsets)

    def ask(part: pa.Table) -> pa.Table:
        found: dict[str, list[np.ndarray]] = {}
        for name, _, whole, at in by_model(part):
            if name is not None:
                found.setdefault(name, []).append(counted(whole, at)[0])
        each = {name: np.unique(np.concatenate(codes)) for name, codes in found.items()}
        langs = pa.array([name for name, codes in each.items() for _ in range(len(codes))], pa.string())
        codes = np.concatenate([np.zeros(0, np.uint64), *each.values()])
        return pa.table([pa.array(np.full(len(codes), part.column("block")[0].as_py())), langs, pa.array(codes.view(np.int64))], names=["block", "lang", "gram"])

    def score(part: pa.Table, back: pa.Table) -> pa.Table:
        mean, n = np.zeros(len(part)), np.zeros(len(part), np.int64)
        at_hand, table = None, None
        for name, places, whole, at in by_model(part):
            n[places] = size = np.diff(at) - (ORDER - 1)
            if name is None:
                continue
            if name != at_hand:
                mine = back.filter(pc.equal(back.column("lang"), name))
                at_hand, table = name, Lookup(mine.column("gram").to_numpy().view(np.uint64), mine.column("value").to_numpy())
            sums = np.concatenate([[0], np.cumsum(table.get(grams(whole, ORDER))[0], dtype=np.float64)])
            mean[places] = (sums[at[1:]] - sums[at[:-1] + ORDER - 1]) / size
        return pa.table([part.column("doc_id"), part.column("lang"), pa.array(n), pa.array(10.0**-mean), part.column("row_key")], names=["doc_id", "lang", "n_symbols", "perplexity", "row_key"])

    # looked up and scored when this is called: models and answers aren't read later
    asked = kept(blocked.groupBy("block").applyInArrow(ask, "block long, lang string, gram long"), "kn-asked")
    logs = gram_logs(asked.select("lang", "gram").distinct(), models)
    back = kept(asked.join(logs, ["lang", "gram"]).select("block", "lang", "gram", "value"), "kn-answers")
    let_go(asked)
    let_go(logs)
    scores = kept(blocked.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(score, "doc_id long, lang string, n_symbols long, perplexity double, row_key long"), "kn-scores")
    let_go(back)
    return scores


def with_thresholds(scores: DataFrame, labels: DataFrame, quantile: float = QUANTILE, least: int = LEAST_TRUSTED) -> DataFrame:
    """scores with threshold and keep: each language's quantile of the perplexity of all its trusted documents."""
    trusted = scores.join(trusted_ids(labels), "doc_id", "left_semi")
    q = F.percentile_approx("perplexity", F.lit(quantile), F.lit(100_000))
    whole = trusted.agg(q.alias("all_languages"))
    own = trusted.groupBy("lang").agg(F.when(F.count(F.lit(1)) >= least, q).alias("own")).filter("lang is not null and own is not null")
    out = scores.join(kept(own, "kn-thresholds"), "lang", "left").crossJoin(F.broadcast(whole))  # one row
    limit = F.coalesce("own", "all_languages")
    return out.select(*scores.columns, limit.alias("threshold"), F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("keep"))


def classify_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, train_rows: int | None = None) -> DataFrame:
    """One row for each document: doc_id, lang, n_symbols, perplexity, row_key, threshold, keep.

    docs has doc_id, text and lang, labels has doc_id, quality and toxic; other columns are not read. Null text counts
    as empty; a very long text is read in its block like others; a null or unmodelled language is scored by the model of all; without trusted rows perplexity is 1 and all
    is kept. Repeated rows give repeated result rows, null ids have rows too, and an empty table gives an empty result.
    The model counts all trusted documents, unless train_rows asks for so many of each language.
    """
    texts = trusted_sample(docs, labels, train_rows)
    own = texts.select("lang").filter(F.col("lang") != ANY).distinct()
    overall = not docs.select("lang").distinct().join(own, "lang", "left_anti").isEmpty()  # some language has no model of its own
    models = trained_models(texts, overall)
    scores = perplexities(docs, models)
    for model in models.values():
        let_go(model)
    return with_thresholds(scores, labels, quantile)
