"""Where the sources of a language differ: term shares per source against each other and against the language, in exact integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.shared import cut, text_slices
from sessionloom.sources.scratch import new_path

TERM_BYTES = np.array([b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)], np.uint8)  # of UTF-8: A-Z in lower case, what no term has as spaces
SLICE = 1 << 20  # bytes of texts that are split at a time
TALLIED, LOOSE = 1 << 25, 1 << 23  # bytes of terms and their numbers: summed ones that bags are made of, and those that may wait to be summed
GROUPS = 1 << 16  # sources, likewise
ROWS = 256  # bags that are sent at a time
MARK = "\x1f"  # ends the language, in hex digits, in a vectorizer's word
MOST_TERMS = 2**31 - 1
UNIT = 1_000_000_000  # shares are in billionths
ADDED = 5  # what every count of a kept term is raised by
TILE, BLOCK = 64, 4096  # sources and terms that meet in a task: at most 2 * TILE * BLOCK numbers of 8 bytes


def _bags(docs: DataFrame, least_docs: int = 30) -> DataFrame:
    """lang, source, times, words, seen: for each source in a run of texts and each number of times, the terms that occur so often in its texts there, each behind its language.
    A source without terms there has an empty bag. One bag of each language and run has in seen, as (docs, words), the terms that are in so many texts of the language there; docs is least_docs at most.

    A run is what a task reads, or as much of it as makes TALLIED bytes of terms or has GROUPS sources.
    """

    def run(batches):
        tally = _Tally(least_docs)
        for batch in batches:
            langs, sources = (batch.column(k).to_pylist() for k in (0, 1))
            for first, data, offsets in text_slices(batch.column(2), SLICE):
                last = first + len(offsets) - 1
                tally.add(langs[first:last], sources[first:last], data, offsets)
                if tally.summed >= TALLIED or len(tally.groups) >= GROUPS:
                    yield from tally.bags()
                    tally = _Tally(least_docs)
        yield from tally.bags()

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(run, "lang string, source string, times long, words array<string>, seen array<struct<docs:int,words:array<string>>>")


class _Tally:
    """How often the terms of a run occur in each of its sources, and in how many texts of each language."""

    def __init__(self, least_docs: int):
        self.least_docs, self.size, self.summed = least_docs, 0, 0  # bytes held, and bytes after summing
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: list[pa.Array] = []  # distinct ones
        self.rows: list[tuple[np.ndarray, ...]] = []  # for each of terms: group, place in terms, times, texts

    def add(self, langs: list[str], sources: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(langs, sources)], np.int32)
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(langs), [None, pa.py_buffer(offsets), pa.py_buffer(TERM_BYTES[data])]))
        found = split.flatten().dictionary_encode()
        terms, term = found.dictionary, found.indices.to_numpy()
        text = np.repeat(np.arange(len(langs)), pc.list_value_length(split).to_numpy())
        key = np.sort((text * len(terms) + term)[term != terms.index("").as_py()])  # splitting finds "" at the ends of texts
        first = np.flatnonzero(np.diff(key, prepend=-1))
        text, term = np.divmod(key[first], len(terms))
        self._hold(terms, group[text], term, np.diff(first, append=len(key)), np.ones(len(text), np.int32))
        if self.size > 2 * self.summed + LOOSE:
            self._sum()

    def _hold(self, terms: pa.Array, group: np.ndarray, term: np.ndarray, times: np.ndarray, docs: np.ndarray) -> None:
        self.terms.append(terms)
        self.rows.append((group.astype(np.int32), term.astype(np.int32), times, docs.astype(np.int32)))
        self.size += terms.nbytes + sum(x.nbytes for x in self.rows[-1])

    def _sum(self) -> None:
        """Hold each group's terms once."""
        found = pa.concat_arrays(self.terms).dictionary_encode()
        places = np.split(found.indices.to_numpy(), np.cumsum([len(x) for x in self.terms])[:-1])
        key = np.concatenate([g * np.int64(len(found.dictionary)) + p[t] for p, (g, t, _, _) in zip(places, self.rows)])
        times, docs = (np.concatenate([x[k] for x in self.rows]) for k in (2, 3))
        key, times, docs = _summed(key, times, docs)
        self.terms, self.rows, self.size = [], [], 0
        self._hold(found.dictionary, *np.divmod(key, len(found.dictionary)), times, docs)
        self.summed = self.size

    def bags(self) -> Iterator[pa.RecordBatch]:
        if not self.groups:
            return
        self._sum()
        groups = sorted(self.groups)
        langs = sorted({lang for lang, _ in groups})
        lang_of = np.searchsorted(np.array(langs, object), np.array([lang for lang, _ in groups], object))
        rank = np.argsort([self.groups[x] for x in groups])
        (terms,), ((group, term, times, docs),) = self.terms, self.rows
        heads = pa.array([lang.encode().hex() + MARK for lang in langs], pa.large_string())

        def listed(of: np.ndarray, term: np.ndarray, times: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
            """of and times without repeats, where the words of each two end (from 0 on), and all words. lang: of each of."""
            order = np.lexsort((times, of))
            of, term, times = of[order], term[order], times[order]
            first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(times, prepend=-1) != 0))
            words = pc.binary_join_element_wise(heads.take(pa.array(lang[of])), terms.take(pa.array(term)), pa.scalar("", heads.type)).cast(pa.string())
            return of[first], times[first], np.append(first, len(of)), words

        of, times, ends, words = listed(rank[group], term, times, lang_of)
        silent = np.setdiff1d(np.arange(len(groups)), of)
        at = np.searchsorted(of, silent)
        of, times, ends = np.insert(of, at, silent), np.insert(times, at, 1), np.insert(ends, at, ends[at])

        key, docs = _summed(lang_of[rank[group]] * len(terms) + term, docs)
        lang, docs, seen_ends, seen_words = listed(*np.divmod(key, len(terms)), np.minimum(docs, self.least_docs), np.arange(len(langs)))
        seen = pa.StructArray.from_arrays([pa.array(docs, pa.int32()), pa.ListArray.from_arrays(pa.array(seen_ends, pa.int32()), seen_words)], ["docs", "words"])
        bearing = np.zeros(len(of), np.int64)
        bearing[np.searchsorted(lang_of[of], np.arange(len(langs)))] = np.bincount(lang, minlength=len(langs))

        columns = [pa.array([x[k] for x in groups], pa.string()).take(pa.array(of)) for k in (0, 1)]
        columns += [pa.array(times, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *bearing]), pa.int32()), seen)]
        batch = pa.RecordBatch.from_arrays(columns, ["lang", "source", "times", "words", "seen"])
        yield from (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS))


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct keys in order, and the sums of their values."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return [key[first], *[np.add.reduceat(v[order], first) if len(v) else v for v in values]]


def _share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(UNIT * (count + 5) / (total + 5 * terms)), in decimals of 38 digits."""
    part = F.lit(UNIT).cast("decimal(10,0)") * (_col(count) + ADDED).cast("decimal(19,0)")
    whole = (_col(total) + ADDED * _col(terms)).cast("decimal(19,0)")
    return 1 + F.call_function("div", part, whole)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fitted(words: DataFrame, least_docs: int) -> CountVectorizerModel:
    """The vectorizer of words; where no term is in enough documents, which it refuses, one whose only word no text has."""
    try:
        return CountVectorizer(inputCol="words", outputCol="vector", minDF=float(least_docs), vocabSize=MOST_TERMS).fit(words)
    except IllegalArgumentException as error:
        if "vocabulary size" not in str(error):
            raise
        return CountVectorizerModel.from_vocabulary([MARK], inputCol="words", outputCol="vector")


def _indices(model: CountVectorizerModel, bags: DataFrame) -> DataFrame:
    """lang, source, times, index of every kept term of every bag. A plain explode would filter out bags without any by transforming them all again, twice."""
    vectors = model.transform(bags).select("lang", "source", "times", F.unwrap_udt("vector").alias("vector"))
    return vectors.select("lang", "source", "times", F.explode_outer("vector.indices").alias("index")).where(F.col("index").isNotNull())


def term_counts(docs: DataFrame, least_docs: int = 30) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, vocabulary, counts): (lang, source) of every row of docs; (index, lang, term) of the terms in least_docs documents of their
    language or more; (lang, source, index, count) above zero.

    One CountVectorizer serves all languages, as its words carry their language, so that minDF counts documents of one language. Texts are split once and their terms are tallied by runs of texts: what is
    stored are bags. The vectorizer is fitted to a run's terms as often as texts there have them, up to least_docs, which decides as all texts do whether least_docs have a term;
    it transforms bags that have a term once for all texts of a source in a run. Vectors of bags, times their number, are summed by source and term.
    """
    spark = docs.sparkSession
    bags = cut(_bags(docs, least_docs), "bags")
    seen = bags.select(F.explode("seen").alias("seen")).select("seen.docs", "seen.words")
    model = _fitted(seen.select("words", F.explode(F.sequence(F.lit(1), "docs"))), least_docs)
    saved = new_path(spark, "vocabulary")
    model.write().save(saved)
    vocabulary = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("index", "word")).where(F.col("word") != MARK)
    lang, term = (F.split_part("word", F.lit(MARK), F.lit(k)) for k in (1, 2))
    vocabulary = vocabulary.select("index", F.unhex(lang).cast("string").alias("lang"), term.alias("term"))
    groups = cut(bags.select("lang", "source").distinct(), "groups")
    counts = cut(_indices(model, bags).groupBy("lang", "source", "index").agg(F.sum("times").alias("count")), "counts")
    return groups, cut(vocabulary, "terms"), counts


def _apart(part: pd.DataFrame, size: int) -> pd.DataFrame:
    """Sums of the differences of shares, for every two sources of a pair of tiles over the terms of a block that either tile has.

    Rows of index -1 name the sources and the share that a term without occurrences has there.
    """
    lang, lo, hi = part["lang"].iloc[0], part["lo"].iloc[0], part["hi"].iloc[0]
    named = part["index"].to_numpy() < 0
    nth, none = part["nth"].to_numpy()[named], part["p"].to_numpy()[named]
    order = np.argsort(nth)
    nth, none = nth[order], none[order]
    terms, at = np.unique(part["index"].to_numpy()[~named], return_inverse=True)
    shares = np.repeat(none[:, None], len(terms), axis=1)
    shares[np.searchsorted(nth, part["nth"].to_numpy()[~named]), at] = part["p"].to_numpy()[~named]
    tile = nth // size
    rows = []
    for i in np.flatnonzero(tile == lo):
        j = np.flatnonzero((tile == hi) & (nth > nth[i]))
        rows.append(pd.DataFrame({"a": nth[i], "b": nth[j], "apart": np.abs(shares[j] - shares[i]).sum(axis=1), "rest": np.abs(none[j] - none[i])}))
    out = pd.concat(rows) if rows else pd.DataFrame({"a": [], "b": [], "apart": [], "rest": []}, dtype="int64")
    return out.assign(lang=lang, met=len(terms))[["lang", "a", "b", "apart", "rest", "met"]]


def _pairs(groups: DataFrame, counts: DataFrame, tile: int, block: int) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, by number. groups: lang, nth, tiles, blocks, terms, none; counts: lang, nth, tiles, index, p."""
    named = groups.select("lang", "nth", "tiles", F.explode("blocks").alias("block"), F.lit(-1).alias("index"), F.col("none").alias("p"))
    rows = counts.select("lang", "nth", "tiles", F.expr(f"index div {block}").alias("block"), "index", "p").unionByName(named)
    own = F.expr(f"nth div {tile}")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.withColumns({"lo": F.least(own, "other"), "hi": F.greatest(own, "other")})
    parts = rows.groupBy("lang", "lo", "hi", "block").applyInPandas(lambda part: _apart(part, tile), "lang string, a long, b long, apart long, rest long, met long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"), F.sum("met").alias("met"), F.max("rest").alias("rest"))
    terms = groups.select("lang", "terms").distinct()
    return sums.join(terms, "lang").select("lang", "a", "b", (F.col("apart") + (F.col("terms") - F.col("met")) * F.col("rest")).alias("value"))


def audit(docs: DataFrame, least_docs: int = 30, most: int = 50, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """How far the sources of each language are apart, and which terms each source has more of than its language.

    Terms are runs of ASCII letters and of characters beyond ASCII, A-Z in lower case; kept are those in least_docs documents of the language or more. A term's
    share p in a source or language is 1 + floor(10**9 * (count + 5) / (N + 5 * V)), V the kept terms and N all their occurrences there.

    Returns lang, source, part, item, value, rank. Part `pair` has every other source of the language, with the sum of |p - p'| over all kept
    terms (0 if none is kept); part `term` the `most` terms that occur there and have most share beyond the language's. Rank goes from 1
    by value descending, then item in order of its bytes. Null lang, source and text are ''; repeated rows count as often as they come;
    a source without terms is compared like any other; a language of one source has no pairs. Other columns are not read. An empty table gives no rows.

    Only the terms that either of two sources has are compared one by one: the others differ by the same constant, which is added as often as they are. Sources
    meet in tiles of `tile` by blocks of `block` terms, so no task grows with the number of sources, terms or documents, and no row per term and pair is made. Pairs
    are as many as the result. The vocabulary is the vectorizer's: it passes through the driver and goes to every task; at least least_docs documents share each of its terms.
    """
    docs = docs.select("lang", "source", "text")
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")
    groups, vocabulary, counts = term_counts(docs, least_docs)
    kept = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.collect_set(F.expr(f"index div {block}")).alias("blocks"))
    by_lang = Window.partitionBy("lang")
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("blocks", F.array(F.lit(0).cast("long"))).alias("blocks"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("nth"), F.sum(F.coalesce("total", F.lit(0))).over(by_lang).alias("lang_total"), F.ceil(F.count(F.lit(1)).over(by_lang) / tile).alias("tiles"),
    )
    groups = cut(groups.withColumn("none", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(0)), "sources")
    shares = counts.join(groups.drop("none", "blocks"), ["lang", "source"]).withColumn("p", _share("count", "total", "terms"))

    pairs = cut(_pairs(groups, shares, tile, block), "pairs")
    names = groups.select("lang", "source", "nth")
    both = pairs.select("lang", "a", "b", "value").unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    both = both.join(names.select("lang", "source", F.col("nth").alias("a")), ["lang", "a"]).join(names.select("lang", F.col("source").alias("item"), F.col("nth").alias("b")), ["lang", "b"])
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ordered).alias("rank"))

    whole = counts.groupBy("lang", "index").agg(F.sum("count").alias("lang_count"))
    more = shares.join(whole, ["lang", "index"]).withColumn("value", F.col("p") - _share("lang_count", "lang_total", "terms")).where("value > 0")
    terms = more.join(vocabulary.select("index", F.col("term").alias("item")), "index").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    term_rows = terms.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= most)
    return pair_rows.unionByName(term_rows)
