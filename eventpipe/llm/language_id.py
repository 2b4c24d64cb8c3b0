"""Language identification by fusing evidence in Bayes' rule.

Per document four kinds of evidence meet: the likelihood of the text under a
byte-trigram model of each language, the language its markup declares, the
suffix of its address, and its host. What a declaration or a suffix says about
the language is counted over all documents, as is the prior of each host,
smoothed towards that of its parent domain, which is smoothed towards the
corpus. The text likelihood is tempered, as trigrams of a text depend on each
other: it counts as that of ``TEXT_WEIGHT`` independent trigrams at most.

Every language that a row declares by a code of two or three letters is a
possible answer, however few rows do; there are at most 18,252 such codes. One
more answer is none of them, for other languages and junk: its trigrams are
all alike, and ``MARGIN`` less likely than those of a language in its own texts.
A text that it explains best is rejected. The models are sparse and scored in
blocks of ``BLOCK_ENTRIES`` numbers, so no worker holds more of them at once; a
row takes a number for each language.

The trigram models alone are fitted on a sample: by hash about ``TRAIN_DOCS``
documents, the same number of each declared language, and of equal texts one.
Everything else is a grouped aggregation over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.byte_bpe import slices
from eventpipe.llm.common import Scratch, bound_batches, join_groups, trim_memory

TRAIN_DOCS = 4_000
# Of each language at least so many, if there are.
LEAST_TRAIN_DOCS = 20
# What a row may declare as its language: the code before a region or script.
CODE = r"^\s*([a-z]{2,3})(?![a-z])"
SLOTS = 1 << 16
# Share of a model that is the same for every slot, seen in the language's sample or not.
UNSEEN = 0.1
# By how much (in logarithms, a trigram) a text may be less likely than those of its language before it is none.
MARGIN = 3.5
# Numbers of one block of models, and of one batch of scores.
BLOCK_ENTRIES = 1 << 21
BATCH_ENTRIES = 1 << 20
# Languages summed up side by side, and counted in one go.
WIDTH = 64
TEXT_WEIGHT = 60.0
HOST_WEIGHT = 20.0
DOMAIN_WEIGHT = 50.0
EVIDENCE_WEIGHT = 20.0
# A declared language or suffix counts for at most this much against another.
MAX_EVIDENCE = 4.0
MIN_PROBABILITY = 0.5
MIN_LETTERS = 1


def markup_language(html: Column) -> Column:
    """Two or three letters of the ``lang`` of an html element, else null."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    """The last label of a host with a dot; addresses of digits have none."""
    last = F.substring_index(host, ".", -1)
    return F.when(host.contains(".") & ~last.rlike(r"^\d+$"), last)


def parent_of(host: Column) -> Column:
    """The last two labels of a host; one without a dot has the empty parent."""
    return F.when(host.contains("."), F.substring_index(host, ".", -2)).otherwise("")


def trigram_slots(data: bytes) -> np.ndarray:
    """Slots of the byte trigrams of lower-cased text, blanks and ASCII signs as one blank."""
    codes = _FOLD[np.frombuffer(data, dtype=np.uint8)]
    codes = codes[(codes != 32) | (np.append(np.uint8(0), codes[:-1]) != 32)].astype(np.uint32)
    if len(codes) < 3:
        return np.empty(0, np.uint32)
    mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
    return mixed >> np.uint32(16)


def _folding() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        table[b] = ord(chr(b).lower()) if chr(b).isalpha() else 32
    return table


_FOLD = _folding()


def train(docs: DataFrame, languages: dict[str, int], scratch: Scratch) -> Iterator[tuple]:
    """Models of the languages (name: rows that declare it) in blocks, from a sample; the last stands for none of them.

    A block is (starts, which, more, least): ``least`` are the log-probabilities
    of a slot that a language's sample does not have; what a slot that it has gets
    on top is in ``more``, by slot, with the language's place in ``which``.
    """
    quota = max(TRAIN_DOCS // len(languages), LEAST_TRAIN_DOCS)
    shares = F.split(F.lit(",".join(repr(min(1.0, quota / n)) for n in languages.values())), ",").cast("array<double>")
    names = F.split(F.lit(",".join(languages)), ",")
    share = F.get(shares, (F.array_position(names, F.col("declared")) - 1).cast("int"))
    drawn = docs.where(F.col("declared").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000))
    # A group of copies is drawn as a whole or not at all, and is one text.
    rows = drawn.groupBy("declared", F.xxhash64("text")).agg(F.first("text").alias("text"))
    index = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for i, own in counts.items():
                used = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), i, np.int32)), pa.array(used, pa.int32()), pa.array(own[used])],
                    names=["language", "slot", "n"],
                )
            counts.clear()

        for batch in batches:
            for start, part in slices(batch.column(1)):
                for language, text in zip(batch.column(0).slice(start, len(part)).to_pylist(), part):
                    i = index[language]
                    if i not in counts and len(counts) == WIDTH:
                        yield from counted()
                    own = counts.setdefault(i, np.zeros(SLOTS, np.int64))
                    own += np.bincount(trigram_slots(text.encode()), minlength=SLOTS)
        yield from counted()

    seen = rows.select("declared", "text").mapInArrow(count, "language int, slot int, n bigint")
    seen = scratch.settle(seen.groupBy("language", "slot").agg(F.sum("n").alias("n")), "trigrams")
    entries = dict.fromkeys(range(len(languages)), 0) | {
        r["language"]: r["entries"] for r in seen.groupBy("language").agg(F.count("*").alias("entries")).collect()
    }
    first, held, own = 0, 0, []
    for i, more in entries.items():
        if i > first and held + more > BLOCK_ENTRIES:
            yield _block(seen, first, i, own)
            first, held = i, 0
        held += more
    yield _block(seen, first, len(languages), own)
    yield _none_of_them(own)


def _block(seen: DataFrame, first: int, end: int, own: list[float]) -> tuple:
    """The models of the languages first, ..., end - 1; at most ``BLOCK_ENTRIES`` rows, or one model, come to the driver.

    ``own`` gets the mean log-probability of a trigram in each language's own sample.
    """
    table = seen.where(F.col("language").between(first, end - 1)).toArrow()
    which, slot, n = (table.column(c).to_numpy() for c in ("language", "slot", "n"))
    order = np.lexsort((which, slot))
    which, slot, n = which[order] - first, slot[order], n[order].astype(float)
    total = np.maximum(np.bincount(which, weights=n, minlength=end - first), 1)
    starts = np.searchsorted(slot, np.arange(SLOTS + 1))
    least = np.log(UNSEEN / SLOTS)
    found = np.log((1 - UNSEEN) * n / total[which] + UNSEEN / SLOTS)
    own.extend(np.bincount(which, weights=n * found, minlength=end - first) / total)
    return starts, which, found - least, np.full(end - first, least)


def _none_of_them(own: list[float]) -> tuple:
    """The answer that a text is in no language: every trigram is ``MARGIN`` less likely than one of the least regular language is in its own texts."""
    return np.zeros(SLOTS + 1, np.int64), np.empty(0, np.int64), np.empty(0), np.array([min(own) - MARGIN])


def score(model: tuple, used: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Log-likelihoods of a text, given as its slots and their counts, under each model of a block."""
    starts, which, more, least = model
    begin, sizes = starts[used], starts[used + 1] - starts[used]
    at = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return np.bincount(which[at], weights=np.repeat(times, sizes) * more[at], minlength=len(least)) + times.sum() * least


def text_evidence(docs: DataFrame, blocks: Iterator[tuple], n: int) -> DataFrame:
    """``docs`` (key, declared, suffix, host, text) with what the text says of the ``n`` languages, and its ``letters``.

    ``ll`` are log-likelihoods, ``q`` the probabilities they give.
    """
    packed = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]

    def models() -> Iterator[tuple]:
        for block in packed:
            path = getattr(block, "_path", None)
            # A value is cached for good, so of several blocks each is read when it is its turn.
            yield block.value if len(packed) == 1 or path is None else block.load_from_path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BATCH_ENTRIES // n)
        for batch in batches:
            for start, part in slices(batch.column("text")):
                for at in range(0, len(part), step):
                    texts = part[at : at + step]
                    slots = []
                    for text in texts:
                        # As a sum over slots: exact, and bounded for texts of any length.
                        times = np.bincount(trigram_slots(text.encode()), minlength=SLOTS)
                        used = np.flatnonzero(times)
                        slots.append((used.astype(np.int32), times[used]))
                    ll, place = np.empty((len(texts), n)), 0
                    for model in models():
                        end = place + len(model[-1])
                        for i, (used, times) in enumerate(slots):
                            ll[i, place:end] = score(model, used, times)
                        place = end
                    ll *= np.array([min(1.0, TEXT_WEIGHT / max(times.sum(), 1)) for _, times in slots])[:, None]
                    q = np.exp(ll - ll.max(axis=1, keepdims=True))
                    q /= q.sum(axis=1, keepdims=True)
                    offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * n)
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (ll, q)]
                    letters = pa.array([sum(map(str.isalpha, text)) for text in texts], pa.int64())
                    rest = [batch.column(c).slice(start + at, len(texts)) for c in ("key", "declared", "suffix", "host")]
                    yield pa.RecordBatch.from_arrays(
                        [*rest, *lists, letters], names=["key", "declared", "suffix", "host", "ll", "q", "letters"]
                    )
        trim_memory()

    key = docs.schema["key"].dataType.simpleString()
    fields = f"key {key}, declared string, suffix string, host string, ll array<double>, q array<double>, letters bigint"
    return docs.select("key", "declared", "suffix", "host", "text").mapInArrow(run, fields)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once and not once for each element of an array."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def softmax(values: Column) -> Column:
    exps = _let(values, lambda v: _let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
    return _let(exps, lambda e: _let(_total(e), lambda t: F.transform(e, lambda x: x / t)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _constant(values: Sequence[float]) -> Column:
    """An array of doubles as one literal, whatever its length."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _sums(frame: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Rows and summed ``q`` per group: partial sums in each task, so no group is hot; ``WIDTH`` languages side by side."""
    width = min(n, WIDTH)
    parts = F.transform(F.sequence(F.lit(0), F.lit((n - 1) // width)), lambda b: F.slice("q", b * width + 1, F.lit(width)))
    cut = frame.select(*by, F.posexplode(parts).alias("block", "part"))
    own = [F.coalesce(F.sum(F.get("part", F.lit(i))), F.lit(0.0)) for i in range(width)]
    sums = cut.groupBy(*by, "block").agg(F.count("*").alias("rows"), F.array(*own).alias("own"))
    blocks = F.sort_array(F.collect_list(F.struct("block", "own")))
    grouped = sums.groupBy(*by).agg(F.max("rows").alias("rows"), blocks.alias("blocks"))
    return grouped.select(*by, "rows", F.slice(F.flatten(F.col("blocks.own")), 1, n).alias("sums"))


def _plus(sums: Column, prior: Column, weight: float) -> Column:
    """Counts smoothed towards a prior distribution, as a distribution."""
    return _let(_total(sums) + weight, lambda total: F.zip_with(sums, prior, lambda s, p: (s + p * weight) / total))


def _evidence(frame: DataFrame, column: str, prior: list[float], scratch: Scratch) -> DataFrame:
    """(column, rows, log P(value | language) up to a constant) for every value: posterior over prior, bounded."""
    at = _constant(prior)
    grouped = _sums(frame.where(F.col(column).isNotNull()), [column], len(prior))
    ratio = F.zip_with(_plus(F.col("sums"), at, EVIDENCE_WEIGHT), at, lambda p, q: F.log(p / q))
    bounded = F.transform(ratio, lambda v: F.greatest(F.lit(-MAX_EVIDENCE), F.least(F.lit(MAX_EVIDENCE), v)))
    return scratch.settle(grouped.select(column, "rows", bounded.alias(f"of_{column}")), f"by-{column}")


def identify(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(key, language, probability, kept) for every row of ``rows`` (key, text, declared, suffix, host).

    ``declared``, ``suffix`` and ``host`` may be null; such evidence is left
    out, and a row without a host has the corpus prior. ``kept`` is false for a
    text without letters and where no language has ``MIN_PROBABILITY``. A null
    or empty text has no letters: its language is what the other evidence
    says. A text that is none of the languages has a null ``language``, and the
    probability is that of none. Every declared language is a possible answer;
    work and rows on disk grow with their number. Ties go to the language more
    rows declare, then to the smaller name. Other forms of ``declared`` than a
    code, with or without a region, are no declaration.
    Without any declared language there is nothing to tell texts by:
    ``language`` is null, and texts with letters are kept.
    Keys may be null or repeat: every row gets a row. Other columns are ignored.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark, "language-id")
    bound_batches(spark)
    code = F.regexp_extract(F.lower("declared"), CODE, 1)
    docs = rows.select("key", "text", F.when(code != "", code).alias("declared"), "suffix", "host")
    declared = docs.groupBy("declared").agg(F.count("*").alias("rows"))
    top = declared.where("declared IS NOT NULL").orderBy(F.desc("rows"), "declared").collect()
    languages = [r["declared"] for r in top]
    if not languages:
        letters = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
        return rows.select("key", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"), letters.alias("kept"))
    # The last answer is none of the languages.
    n = len(languages) + 1
    models = train(docs, {r["declared"]: r["rows"] for r in top}, scratch)
    found = scratch.settle(text_evidence(docs, models, n), "text")

    whole = _sums(found, [], n).first()
    prior = [(s + 1.0) / (whole["rows"] + n) for s in whole["sums"]]
    at = _constant(prior)
    hosts = scratch.settle(
        _sums(found.where("host IS NOT NULL"), ["host"], n).withColumn("parent", parent_of(F.col("host"))), "hosts"
    )
    parents = _sums(hosts.select("parent", F.col("sums").alias("q")), ["parent"], n)
    domain = _plus(F.col("sums"), at, DOMAIN_WEIGHT)
    parents = scratch.settle(parents.select("parent", F.col("rows").alias("hosts"), domain.alias("of_parent")), "parents")
    priors = join_groups(hosts, parents, ["parent"], "hosts", ["host"]).select(
        "host", "rows", F.transform(_plus(F.col("sums"), F.col("of_parent"), HOST_WEIGHT), lambda v: F.log(v)).alias("of_host")
    )
    joined = join_groups(found, scratch.settle(priors, "priors"), ["host"], "rows", ["key", "letters"], "left")
    for column in ("declared", "suffix"):
        groups = _evidence(found, column, prior, scratch)
        joined = join_groups(joined.drop("rows"), groups, [column], "rows", ["key", "letters"], "left")

    nothing = F.array_repeat(F.lit(0.0), n)
    total = F.coalesce("of_host", _constant(np.log(prior)))
    for column in ("ll", "of_declared", "of_suffix"):
        total = F.zip_with(total, F.coalesce(column, nothing), lambda a, b: a + b)
    fused = joined.select("key", "letters", softmax(total).alias("p"))
    best = F.array_max("p")
    return fused.select(
        "key",
        F.get(F.split(F.lit(",".join(languages)), ","), (F.array_position("p", best) - 1).cast("int")).alias("language"),
        best.alias("probability"),
        ((F.col("letters") >= MIN_LETTERS) & (best >= MIN_PROBABILITY) & (F.array_position("p", best) < n)).alias("kept"),
    )


def document_evidence(docs: DataFrame, key: Column) -> DataFrame:
    """Rows for ``identify`` from ``documents``: the declared ``lang``, and ``source`` as host."""
    host = F.lower("source")
    return docs.select(
        key.alias("key"), "text", F.col("lang").alias("declared"), suffix_of(host).alias("suffix"), host.alias("host")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(document_evidence(docs, F.col("doc_id"))).withColumnRenamed("key", "doc_id")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages``: markup language, address suffix and host of each."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = host_of(F.col("url"))
    rows = pages.select(
        F.col("page_id").alias("key"), text.alias("text"), markup_language(F.col("html")).alias("declared"),
        suffix_of(host).alias("suffix"), host.alias("host"),
    )
    return identify(rows).withColumnRenamed("key", "page_id")
