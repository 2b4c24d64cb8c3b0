"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

Spark deals the texts out; each Python worker holds an in-memory DuckDB with
the merge table. Texts are cut into pre-tokens. Those the worker has not seen
lately are merged together by one recursive query: token-position rows join
the merge table, every word contracts its leftmost pair of minimum rank, and
words without a pair leave, until none is left. Ids are decoded by an ordered
aggregation over the vocabulary.

A recursive query keeps the rows of every step. Words of over ``LONG_BYTES``
(whole clauses, in scripts without spaces) therefore contract all places of
their least pair in a step, which comes to the same, as no merge can make a pair
of a lesser rank than its own; and the query stops after so many steps that it
holds ``HELD_ROWS``, and goes on from where it stood. A word may have any length.

Nothing is shuffled. A worker that holds over ``CACHE_WORDS`` keeps those it met again. Beside them it holds one slice of
texts and one block of words or ids in DuckDB at a time, and between partitions no DuckDB.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpipe.llm.common import bound_batches, trim_memory

CACHE_WORDS = 300_000
CACHE_CHUNKS = 100_000
CACHE_CHARS = 8_000_000
LONG_BYTES = 64
QUERY_WORDS = 16_000
# Bytes of long words in a query (one word may have more), and rows that all steps of it may hold.
QUERY_BYTES, HELD_ROWS = 100_000, 1_000_000
SLICE_CHARS = 2_000_000
# Bytes of texts that are encoded together, and ids that are decoded together (one text may have more).
ENCODE_CHARS, DECODE_IDS = 1_000_000, 150_000
MEMORY_LIMIT = "128MB"
# Below this all versions of Unicode that libraries follow agree on letters, numbers and spaces.
RARE_FROM = "\u0500"
RARE = re.compile("[^\x00-\u04ff]")
# A character of each class of the pattern that every version knows, and one of none.
CLASSES = {r"\p{L}": "\u4e2d", r"\p{N}": "\u0663", r"\s": "\u2003"}
OTHER_CHAR = "\u2020"

# State rows: a position's id and its right neighbour's (-1 at the end of a word).
# A step's key is rank and position, so its minimum is the leftmost pair of least rank.
# Words without a pair come out once more, not live, and leave the recursion.
# On one thread, joins hand rows on in the order of (w, pos), which saves a sort a step; each step makes sure of it.
MERGE = """
WITH RECURSIVE state(live, w, pos, id, after) AS (
  SELECT true, w, pos, id, after FROM words
  UNION ALL (
    WITH keyed AS MATERIALIZED (
      SELECT w, pos, id, after, (merged::BIGINT << 20) | pos AS key
      FROM state LEFT JOIN merges ON pair = ((id::BIGINT << 20) | after)
      WHERE live
    ),
    best AS (SELECT w, min(key) AS best FROM keyed GROUP BY w),
    cut AS (
      SELECT best IS NOT NULL AS live, w, pos, CASE WHEN key = best THEN (best >> 20)::INT ELSE id END AS id,
        CASE WHEN lag((w::BIGINT << 20) | pos) OVER () >= ((w::BIGINT << 20) | pos) THEN error('rows out of order')
          ELSE lag(key = best) OVER () END AS taken
      FROM keyed JOIN best USING (w)
    )
    SELECT live, w, pos, id, CASE WHEN lead(w) OVER () = w THEN lead(id) OVER () ELSE -1 END
    FROM cut WHERE taken IS NOT TRUE
  )
)
SELECT w, id FROM state WHERE NOT live ORDER BY w, pos
"""
# For an engine that hands rows on in another order.
MERGE_SORTED = MERGE.replace("OVER ()", "OVER (ORDER BY w, pos)")
# All places of a word's least pair at once. Where they overlap (a pair of two equal ids, in a run of them), every other
# one from the left is taken. ``$1`` steps at most; words that are not through come out live.
MERGE_LONG = """
WITH RECURSIVE state(step, live, w, pos, id, after) AS (
  SELECT 0, true, w, pos, id, after FROM words
  UNION ALL (
    WITH keyed AS MATERIALIZED (
      SELECT step, w, pos, id, after, merged
      FROM state LEFT JOIN merges ON pair = ((id::BIGINT << 20) | after)
      WHERE live AND step < $1
    ),
    best AS (SELECT w, min(merged) AS best FROM keyed GROUP BY w),
    marked AS (
      SELECT step, w, pos, id, best, coalesce(merged = best, false) AS hit,
        row_number() OVER seq AS nr, coalesce(lag(merged = best) OVER seq, false) AS hit_before
      FROM keyed JOIN best USING (w) WINDOW seq AS (PARTITION BY w ORDER BY pos)
    ),
    runs AS (
      SELECT step, w, pos, id, best, hit,
        nr - max(CASE WHEN hit AND NOT hit_before THEN nr END) OVER (PARTITION BY w ORDER BY pos) AS since
      FROM marked
    ),
    cut AS (
      SELECT step, w, pos, best, CASE WHEN hit AND since % 2 = 0 THEN best ELSE id END AS id,
        lag(hit AND since % 2 = 0) OVER (PARTITION BY w ORDER BY pos) AS taken
      FROM runs
    )
    SELECT step + 1, best IS NOT NULL, w, pos, id, coalesce(lead(id) OVER (PARTITION BY w ORDER BY pos), -1)
    FROM cut WHERE taken IS NOT TRUE
  )
)
SELECT live, w, pos, id, after FROM state WHERE NOT live OR step = $1 ORDER BY w, pos
"""
# Bytes stand as the characters with their numbers, as SQL joins texts only.
DECODE = """
SELECT w, string_agg(piece, '') AS text
FROM (SELECT w, pos, piece FROM tokens JOIN vocabulary USING (id) ORDER BY w, pos) GROUP BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def space_chunks(text: str) -> list[str]:
    """Cut before every space that opens a pre-token; all chunks but the first stand for ' ' + chunk.

    A space between two white spaces, or one that ends the text after another,
    belongs to a run of white space, which stays whole.
    """
    if re.search(r"\s (?:\s|\Z)", text):
        return re.split(r" (?=\S)", text)
    return text.split(" ")


class Coder:
    """Encodes and decodes within one Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.classes: dict[str, object] = {}
        self.stand_ins: dict[str, str] = {}
        self.ranks = read_ranks(ranks_path)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None:
                    pairs.extend(((left << 20) | right, rank))
        pair, merged = np.frombuffer(pairs, np.int64).reshape(-1, 2).T
        self.tables = {
            "merges": pa.table({"pair": pa.array(pair), "merged": pa.array(merged, pa.int32())}),
            "vocabulary": pa.table({
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "piece": pa.array([token.decode("latin-1") for token in self.ranks], pa.string()),
            }),
        }
        self._db = None
        self.words: dict[str, bytes] = {}  # pre-token -> ids
        self.again: set[str] = set()  # pre-tokens met in several slices
        self.chunks: dict[str, bytes] = {}  # chunk after a space -> ids
        self.chars = 0  # of all chunks held

    @property
    def db(self):
        """The connection to the tables, opened when it is needed."""
        if self._db is None:
            import duckdb

            self._db = duckdb.connect()
            self._db.execute("SET threads = 1")
            self._db.execute(f"SET memory_limit = '{MEMORY_LIMIT}'")
            self._db.execute("SET temp_directory = ''")
            for name, table in self.tables.items():
                self._db.register("given", table)
                self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self._db.unregister("given")
        return self._db

    def rest(self) -> None:
        """Close the connection: what DuckDB holds is given back, the words stay."""
        if self._db is not None:
            self._db.close()
            self._db = None

    def find(self, text: str) -> list[str]:
        """Pre-tokens of a text, its characters classed as the tiktoken library does.

        Libraries follow different versions of Unicode. A character they class
        differently is replaced by one of the right class while the text is cut.
        """
        if text.isascii() or not (rare := RARE.findall(text)):
            return self.pattern.findall(text)
        plain = "".join([self._stand_in(c) for c in text]) if any(self._stand_in(c) != c for c in set(rare)) else text
        return [text[m.start() : m.end()] for m in self.pattern.finditer(plain)]

    def _stand_in(self, char: str) -> str:
        if char < RARE_FROM:
            return char
        if char not in self.stand_ins:
            import regex
            import tiktoken

            if not self.classes:
                single = {bytes([b]): b for b in range(256)}
                for name in CLASSES:
                    self.classes[name] = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
            right = next((n for n in CLASSES if self.classes[n].encode_ordinary(char)), "")
            own = next((n for n in CLASSES if regex.match(n, char)), "")
            self.stand_ins[char] = char if own == right else CLASSES.get(right, OTHER_CHAR)
        return self.stand_ins[char]

    def _learn(self, words: set[str]) -> None:
        """Ids of words that are not in the cache yet."""
        short, long = [], []
        for word in words:
            token = word.encode("utf-8")
            if (rank := self.ranks.get(token)) is not None:
                self.words[word] = rank.to_bytes(4, "little")
            else:
                (long if len(token) > LONG_BYTES else short).append((word, token))
        for start in range(0, len(short), QUERY_WORDS):
            names, tokens = zip(*short[start : start + QUERY_WORDS])
            self.words.update(zip(names, self._merged(self._positions(tokens), len(tokens))))
        block, held = [], 0
        for item in [*long, None]:
            if block and (item is None or held + len(item[1]) > QUERY_BYTES):
                names, tokens = zip(*block)
                self.words.update(zip(names, self._merged_long(self._positions(tokens), len(tokens))))
                block, held = [], 0
            if item:
                block.append(item)
                held += len(item[1])

    def _forget(self) -> None:
        """Leave out the words that were not met again, or all if those are most."""
        kept = {word: ids for word in self.again if (ids := self.words.get(word)) is not None}
        self.words = kept if len(kept) <= CACHE_WORDS // 2 else {}
        self.again = set()

    def _positions(self, tokens: list[bytes]) -> pa.Table:
        """Rows of the state at its start: a row for each byte."""
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        w = np.repeat(np.arange(len(tokens), dtype=np.int32), sizes)
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        after = np.append(ids[1:], np.int32(-1))
        after[np.cumsum(sizes) - 1] = -1
        return pa.table({"w": w, "pos": positions(sizes), "id": ids, "after": after})

    def _query(self, sql: str, words: pa.Table, parameters: tuple = ()) -> dict[str, np.ndarray]:
        self.db.register("words", words)
        try:
            return self.db.execute(sql, parameters).fetchnumpy()
        finally:
            self.db.unregister("words")

    def _merged(self, words: pa.Table, count: int) -> list[bytes]:
        """Packed ids of each word."""
        import duckdb

        try:
            rows = self._query(MERGE, words)
        except duckdb.InvalidInputException as error:
            if "rows out of order" not in str(error):
                raise
            rows = self._query(MERGE_SORTED, words)
        return _packed(rows["w"], rows["id"], count)

    def _merged_long(self, words: pa.Table, count: int) -> list[bytes]:
        """The same, some steps at a time; what is not through goes on as it stands."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while words.num_rows:
            rows = self._query(MERGE_LONG, words, (max(HELD_ROWS // words.num_rows, 1),))
            live = rows.pop("live").astype(bool)
            done.append((rows["w"][~live], rows["id"][~live]))
            words = pa.table({name: column[live] for name, column in rows.items()})
        w, ids = (np.concatenate(parts) for parts in zip(*done))
        order = np.argsort(w, kind="stable")  # a word comes out of one query whole
        return _packed(w[order], ids[order], count)

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence, by ordered aggregations over ``DECODE_IDS`` ids, or over one sequence."""
        out, start, held = [], 0, 0
        for i, ids in enumerate(packed):
            if i > start and held + len(ids) // 4 > DECODE_IDS:
                out += self._decoded(packed[start:i])
                start, held = i, 0
            held += len(ids) // 4
        return out + self._decoded(packed[start:])

    def _decoded(self, packed: list[bytes]) -> list[bytes]:
        sizes = np.array([len(ids) // 4 for ids in packed], dtype=np.int64)
        ids = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
        w = np.repeat(np.arange(len(packed), dtype=np.int32), sizes)
        self.db.register("tokens", pa.table({"w": w, "pos": positions(sizes), "id": ids}))
        texts = dict(self.db.execute(DECODE).fetchall())
        self.db.unregister("tokens")
        return [texts.get(n, "").encode("latin-1") for n in range(len(packed))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.words) > CACHE_WORDS:
            self._forget()
        if len(self.chunks) > CACHE_CHUNKS or self.chars > CACHE_CHARS:
            self.chunks.clear()
            self.chars = 0
        cut = [space_chunks(text) for text in texts]
        opening = {c[0]: self.find(c[0]) for c in cut}
        found = {c: self.find(" " + c) for c in set().union(*(c[1:] for c in cut)).difference(self.chunks)}
        words = set().union(*found.values(), *opening.values())
        new = words.difference(self.words)
        self.again |= words.difference(new)
        self._learn(new)
        of = self.words.__getitem__
        for chunk, words in found.items():
            self.chunks[chunk] = of(words[0]) if len(words) == 1 else b"".join(map(of, words))
            self.chars += len(chunk)
        of_chunk = self.chunks.__getitem__
        return [b"".join([*map(of, opening[c[0]]), *map(of_chunk, c[1:])]) for c in cut]


def positions(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of these sizes."""
    starts = np.cumsum(sizes) - sizes
    return (np.arange(sizes.sum()) - np.repeat(starts, sizes)).astype(np.int32)


def _packed(w: np.ndarray, ids: np.ndarray, count: int) -> list[bytes]:
    """The ids of words 0 to ``count``, sorted by word, as packed sequences."""
    ends = np.searchsorted(w, np.arange(count), side="right") * 4
    flat, start, out = ids.astype("<u4").tobytes(), 0, []
    for end in ends.tolist():
        out.append(flat[start:end])
        start = end
    return out


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return b"".join([i.to_bytes(4, "little") for i in ids])


_coders: dict[tuple[str, str], Coder] = {}


def coder(ranks_path: str, pattern: str) -> Coder:
    """The worker's coder; it outlives a partition."""
    key = (ranks_path, pattern)
    if key not in _coders:
        _coders[key] = Coder(ranks_path, pattern)
    return _coders[key]


def slices(texts: pa.Array | list[str | None], most: int | None = None) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) of at most ``most`` (else ``SLICE_CHARS``) bytes, or of one text; null texts are empty.

    Only one slice at a time is held as Python strings.
    """
    most = most or SLICE_CHARS
    column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string())
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).to_pylist()):
        if i > start and held + (size or 0) > most:
            yield start, [t or "" for t in column.slice(start, i - start).to_pylist()]
            start, held = i, 0
        held += size or 0
    if start < len(column):
        yield start, [t or "" for t in column.slice(start).to_pylist()]


def encoded(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, ids, decoded) of a partition of (doc_id, text)."""
    own = coder(ranks_path, pattern)
    gc.disable()  # collections would go through all words; there are no cycles
    try:
        for batch in batches:
            for start, texts in slices(batch.column(1), ENCODE_CHARS):
                ids = own.encode(texts)
                decoded = own.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )
    finally:
        gc.enable()
        own.rest()
        trim_memory()


def encode_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of the whole text of every row of ``docs`` (doc_id, text, more).

    ``ids`` are packed as little-endian unsigned 32-bit integers, ``decoded``
    are the bytes they stand for. No special tokens: their strings are text. A
    null text is an empty one, with no ids. A text or a word in it may have any length. Rows keep their number, repeated
    ones too; a null doc_id stays null. Other columns are ignored. An empty
    table gives an empty one.
    """
    import public_tokenizers

    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: encoded(batches, ranks_path, pattern), f"doc_id {kind}, ids binary, decoded binary")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest columns for all of ``documents``."""
    coded = encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
