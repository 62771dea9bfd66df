"""How far each source's words are from its language's and from other sources' (operator 12).

*Counting.* Terms are runs of letters (and all characters beyond ASCII), A-Z lower-cased. Tasks count them by
length: terms of up to 8 bytes are packed into one uint64 word, up to 16 bytes into two; these are sorted by
radix, 16 bits at a time, and runs are counted. Longer terms are sorted as bytes, in a bucket for each
length. A task hands on one row per chunk of text, group and term, however often the term occurs there.

*Probabilities.* A language keeps the V terms that at least ``LEAST`` of its documents hold. A group with N
kept terms in all gives a term of ``count`` places ``p = 1 + floor(UNIT * (count + 2) / (N + 2 V))``. The
division is done three decimal digits at a time, so 64 bits are enough for totals below 9 * 10**15.
``f = floor((p - q)**2 / (p + q))`` never leaves 64 bits.

*Audit.* ``pair``: the sum of f over all kept terms between two sources of one language. Kept terms are dealt
into blocks; a task holds one as a matrix of terms by sources and hands on one partial sum per pair.
``term``: for each group, the ten kept terms with the largest f against its language, of those that are
more frequent there.

Null text, language and source count as ''. A text without terms adds its group and nothing else. Repeated
rows and ids count as often as they are there. Ties go to the item whose UTF-8 bytes are less. An empty table
gives no rows. Of the input only text, lang and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_if_small, bytes_of
from riskloom.sources.staging import stage

#: Documents of a language that a kept term is in, at least.
LEAST = 10
#: What probabilities are multiples of, and what is added to every count.
UNIT, PRIOR = 10**9, 2
#: Terms listed for each group.
RANKS = 10
#: Bytes of text counted together in a task.
CHUNK = 8 << 20
#: Counts of kept terms that are dealt into one block, on average.
BLOCK = 500_000
#: Cells of a matrix of terms by sources that a task holds at a time.
CELLS = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """A stable order of rows by unsigned columns, the first being the most significant, 16 bits at a time."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        top = int(column.max()) if len(column) else 0
        for shift in range(0, 8 * column.dtype.itemsize, 16):
            if not top >> shift:
                break
            digit = ((column >> column.dtype.type(shift)) & column.dtype.type(0xFFFF)).astype(np.uint16)[order]
            if digit.size and (digit != digit[0]).any():
                order = order[np.argsort(digit, kind="stable")]  # numpy sorts 16-bit integers by radix
    return order


def _packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as a big-endian number, zeros behind the end."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(8):
        inside = lengths > i
        byte = np.where(inside, data[np.where(inside, starts + i, 0)], 0)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def _runs(columns: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, documents) of each run of equal rows in sorted columns; ``doc`` ascends in a run."""
    n = len(doc)
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    begin = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    count = np.diff(np.append(begin, n))
    return begin, count, np.add.reduceat(fresh.astype(np.int64), begin) if n else np.empty(0, np.int64)


def _strings(raw: bytes, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths that lie end to end."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def count_terms(texts: list[bytes], group: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, term, count, documents) of the terms in each group of texts, by buckets of length."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    letter = _LETTER[data]
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    lengths = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1 - starts
    ends = 1 + np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    doc = np.searchsorted(ends, starts, side="right")
    data = _LOW[data]
    of = group.astype(np.uint32)[doc]
    for low, high in ((0, 8), (8, 16)):
        some = np.flatnonzero((lengths > low) & (lengths <= high))
        if not len(some):
            continue
        size = lengths[some]
        words = [_packed(data, starts[some], size)]
        if low:
            words.append(_packed(data, starts[some] + 8, size - 8))
        order = radix_order([of[some], *words])
        owner, words = of[some][order], [w[order] for w in words]
        begin, count, docs = _runs([owner, *words], doc[some][order])
        cells = np.column_stack([w[begin] for w in words]).astype(">u8").view(np.uint8)
        yield owner[begin], _strings(cells[cells != 0].tobytes(), size[order][begin]), count, docs
    for length in np.unique(lengths[lengths > 16]):
        some = np.flatnonzero(lengths == length)
        raw = b"".join(data[at : at + length].tobytes() for at in starts[some])
        term, which = np.unique(np.frombuffer(raw, f"S{length}"), return_inverse=True)  # no zeros inside a term
        order = radix_order([of[some], which.astype(np.uint32)])
        owner, which = of[some][order], which[order]
        begin, count, docs = _runs([owner, which], doc[some][order])
        yield owner[begin], _strings(term[which[begin]].tobytes(), np.full(len(begin), length)), count, docs


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[tuple[str, str]]]]:
    """Texts and their groups, about ``CHUNK`` bytes at a time."""
    texts, groups, size = [], [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * CHUNK / max(batch.nbytes, CHUNK)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts += bytes_of(part.column(2))
            groups += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
            size += sum(map(len, texts[len(texts) - part.num_rows :]))
            if size >= CHUNK:
                yield texts, groups
                texts, groups, size = [], [], 0
    if texts:
        yield texts, groups


def term_counts(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents) of every chunk of text; a term has a row in each chunk it occurs in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, groups in _chunks(batches):
            names = sorted(set(groups))
            number = {g: i for i, g in enumerate(names)}
            langs, sources = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
            of = np.fromiter((number[g] for g in groups), np.uint32, len(groups))
            for owner, term, count, docs in count_terms(texts, of):
                at = pa.array(owner)
                columns = [langs.take(at), sources.take(at), term, pa.array(count), pa.array(docs)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "documents"])

    schema = "lang string, source string, term string, n long, documents long"
    return df.select("lang", "source", "text").mapInArrow(run, schema)


def kept_counts(df: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, source, term, n, n_lang, first): the counts of all kept terms; one row of each term is its ``first``.

    Everything is dealt by language and term once; counts, documents and sums over a language need no more.
    """
    dealt = term_counts(df).repartition("lang", "term")
    counted = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    same = Window.partitionBy("lang", "term")  # at most a row for each source
    summed = counted.select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(same).alias("n_lang"),
        F.sum("documents").over(same).alias("documents"),
        (F.min("source").over(same) == F.col("source")).alias("first"),
    )
    return summed.where(F.col("documents") >= least).drop("documents")


def group_totals(df: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms) of every group that occurs: its N, its language's N, and V."""
    groups = df.select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("terms"))
    joined = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["total", "terms"])
    lang = Window.partitionBy("lang")  # a row for each source; the result has its square
    return joined.select(
        "lang", "source", "total", F.sum("total").over(lang).alias("lang_total"), F.sum("terms").over(lang).alias("terms")
    )


def _scaled(count: Column, total: Column) -> Column:
    """``1 + floor(UNIT * count / total)`` by long division, three digits at a time; 0 <= count <= total."""
    value, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        rest = rest * 1000
        value = value * 1000 + F.call_function("div", rest, total)
        rest = rest % total
    return value + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def peculiar_terms(kept: DataFrame, totals: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that tell a group most from its language."""
    joined = kept.select("lang", "source", "term", "n", "n_lang").join(totals, ["lang", "source"])
    joined = joined.withColumn("p", _scaled(F.col("n") + PRIOR, F.col("total") + PRIOR * F.col("terms")))
    joined = joined.withColumn("q", _scaled(F.col("n_lang") + PRIOR, F.col("lang_total") + PRIOR * F.col("terms")))
    found = joined.where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # limited before the shuffle
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)


def _scaled_cells(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As ``_scaled``, for a matrix of terms by sources and the total of each source."""
    value, rest = np.zeros_like(count), count.copy()
    for _ in range(3):
        rest *= 1000
        digits, rest = np.divmod(rest, total)
        value = value * 1000 + digits
    return value + 1


def _pair_sums(table: pa.Table) -> pa.Table:
    """Sums of f over the terms of one block, for every pair of sources of a language.

    Rows without a term are the language's sources with their totals; the others are counts.
    """
    lang = table["lang"][0]
    is_head = table["term"].is_null().to_numpy()
    head = table.filter(pa.array(is_head)).sort_by("source")
    rows = table.filter(pa.array(~is_head))
    sources = head["source"].combine_chunks()
    size = len(sources)
    total = head["total"].to_numpy() + PRIOR * head["terms"].to_numpy()
    sums = np.zeros((size, size), np.int64)
    if rows.num_rows:
        column = pc.index_in(rows["source"], sources).to_numpy()
        term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(term, kind="stable")
        term, column, n = term[order], column[order], rows["n"].to_numpy()[order]
        step = max(1, CELLS // size)
        for at in range(0, int(term[-1]) + 1, step):
            low, high = np.searchsorted(term, [at, at + step])
            counts = np.full((int(term[high - 1]) + 1 - at, size), PRIOR, np.int64)
            counts[term[low:high] - at, column[low:high]] += n[low:high]
            p = np.ascontiguousarray(_scaled_cells(counts, total).T)
            for i in range(size - 1):
                gap = p[i + 1 :] - p[i]
                gap *= gap
                gap //= p[i + 1 :] + p[i]
                sums[i, i + 1 :] += gap.sum(axis=1)
    sums += sums.T
    one, two = np.nonzero(~np.eye(size, dtype=bool))
    columns = [pa.repeat(lang, len(one)), sources.take(pa.array(one)), sources.take(pa.array(two)), pa.array(sums[one, two])]
    return pa.table(columns, ["lang", "source", "item", "value"])


def source_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every two sources of a language, the farthest first."""
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    blocks = totals.join(sizes, "lang", "left").withColumn("blocks", F.floor(F.coalesce("rows", F.lit(0)) / BLOCK) + 1)
    none = F.lit(None)
    head = blocks.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source",
        none.cast("string").alias("term"), none.cast("long").alias("n"), "total", "terms",
    )
    # One row per language: a join that shuffled would send a language's counts to one task.
    rows = kept.join(broadcast_if_small(blocks.select("lang", "blocks").distinct()), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source",
        "term", "n", none.cast("long").alias("total"), none.cast("long").alias("terms"),
    )
    schema = "lang string, source string, item string, value long"
    sums = head.unionByName(rows).groupBy("lang", "block").applyInArrow(_pair_sums, schema)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # a row for each source
    return sums.withColumn("rank", F.row_number().over(far))


def audit_sources(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, ranks: int = RANKS
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each group is from others, and by which terms."""
    names = {"text": text_col, "lang": lang_col, "source": source_col}
    rows = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in names.items()])
    kept = stage(kept_counts(rows, least), "kept")
    totals = stage(group_totals(rows, kept), "totals")
    parts = {"pair": source_pairs(kept, totals), "term": peculiar_terms(kept, totals, ranks)}
    pair, term = (p.select("lang", "source", F.lit(k).alias("part"), "item", "value", "rank") for k, p in parts.items())
    return pair.unionByName(term)
