"""Reading level of documents (problem 10): frequency-ranked vocabulary coverage and sentence complexity, calibrated in SQL.

All documents' words are counted, pre-aggregated in each worker, and ranked by frequency within the language that uses
them most. A document's coverage rank at a share q is the size of the smallest such vocabulary, taken from the top,
that covers the share q of its words. Coverage ranks, sentence length and word length are standardised by language and
turned into levels by a linear discriminant whose sums over the labelled rows are SQL aggregates.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from itertools import batched, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.clean import plain
from eventlake.operators.ranking import indexed
from eventlake.session import broadcast_if_small, stored

HELD = 50_000  # most frequent words of a language whose ranks every worker holds; the ranks of rarer ones are joined to the texts that reach them
SHARES = (0.5, 0.6, 0.7, 0.8, 0.9)
FLUSH = 200_000  # counts a worker holds
WORD = re.compile(r"[^\W\d_]++(?:['’][^\W\d_]++)*+")
CHUNK = 500  # texts measured at once
SENTENCE = re.compile(r"[^\W\d_][^.!?;…\n]*+(?:[.!?;…]++(?!\s)[^.!?;…\n]*+)*+")  # from a letter to a stop before white space, or a line's end
FEATURES = tuple(f"cover{round(100 * q)}" for q in SHARES) + ("sentence", "letters", "long_words")


@cache
def _letters() -> np.ndarray:
    """Each code point as it is if it may be part of a word, else a blank."""
    every = np.arange(0x110000, dtype="<u4")
    table = np.full(len(every), ord(" "), "<u4")
    for m in re.finditer(r"[^\W\d_]+|['’]", every.tobytes().decode("utf-32-le", "surrogatepass")):
        table[m.start() : m.end()] = every[m.start() : m.end()]
    return table


def words_of(text: str) -> list[str]:
    """The words of a text, those that WORD finds, in half of its time."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    if "'" in text or "’" in text:  # one that is not between two letters is blank as well
        marks = np.pad((points == ord("'")) | (points == ord("’")), 1, constant_values=True)
        none = marks | np.pad(points == ord(" "), 1, constant_values=True)
        points[marks[1:-1] & (none[:-2] | none[2:])] = ord(" ")
    return points.tobytes().decode("utf-32-le", "surrogatepass").split()


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, n) over all texts, null languages as ``und``."""

    def f(batches):
        held: dict[str, Counter] = {}
        size = 0
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    c = held.setdefault(lang or "und", Counter())
                    c.update(words_of(plain(text).lower()))
            size = sum(map(len, held.values()))
            if size >= FLUSH:
                yield _counted(held)
                held = {}
        if held:
            yield _counted(held)

    return df.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(f, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _counted(held: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, c in held.items() for _ in c]
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([w for c in held.values() for w in c], pa.string()), pa.array([n for c in held.values() for n in c.values()], pa.int64())], names=["lang", "word", "n"])


def ranked_vocabulary(counts: DataFrame, size: int | None = None) -> DataFrame:
    """(word, lang, rank) of all words, or the first ``size`` of each language: a word belongs to the language in which its share of all words is greatest; ties by name."""
    counts = stored(counts)
    total = sorted((r["lang"], r["all"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("all")).collect())  # one row a language
    bits = max(len(total), 2).bit_length()
    langs = counts.sparkSession.createDataFrame([(lang, i, float(2 ** (61 - bits)) / n) for i, (lang, n) in enumerate(total)], "lang string, _no long, _unit double")
    share = counts.join(F.broadcast(langs), "lang")  # one row a language
    # The greatest share and its language as one number, which an aggregate can hash: a text or a struct it would have to sort.
    best = F.max(F.shiftleft((F.col("n") * F.col("_unit")).cast("long"), bits).bitwiseOR(F.col("_no")))
    own = share.groupBy("word").agg(best.bitwiseAND(F.lit((1 << bits) - 1)).alias("_b"), F.sum("n").alias("n"))
    own = own.join(F.broadcast(langs.select(F.col("lang"), F.col("_no"))), F.col("_b") == F.col("_no")).select("word", "lang", "n")
    rows = indexed(own, F.col("lang"), F.desc("n"), F.col("word"))
    starts = rows.groupBy(F.col("lang").alias("_l")).agg(F.min("pos").alias("_s"))
    ranks = rows.join(F.broadcast(starts), F.col("lang") == F.col("_l")).select("word", "lang", (F.col("pos") - F.col("_s") + 1).alias("rank"))  # one row a language
    return ranks if size is None else ranks.where(F.col("rank") <= size)


def features(df: DataFrame, vocabulary: dict[str, tuple[str, int]], size: int = HELD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_key, n, held, lang, FEATURES...) of each text with a word; the language is that of most of its words.

    n is the number of its words and held how many of them have a rank in ``vocabulary``; coverage ranks beyond those are size + 1.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # at most ``size`` words a language

    def f(batches):
        langs = sorted({lang for lang, _ in shared.value.values()}) or ["und"]
        code = {w: (langs.index(lang) << 32) | rank for w, (lang, rank) in shared.value.items()}
        other = (len(langs) << 32) | (size + 1)
        for b in batches:
            ids, hashes, tongue, rows = [], [], [], [np.empty((0, len(FEATURES) + 2))]
            for part in batched(zip(*[b.column(i).to_pylist() for i in range(3)]), CHUNK):
                texts = [plain(text or "") for _, text, _ in part]
                words = [words_of(text.lower()) for text in texts]
                some = [i for i, ws in enumerate(words) if ws]
                if not some:
                    continue
                n = np.array([len(words[i]) for i in some])
                ends = np.cumsum(n)
                starts = ends - n
                every = list(chain.from_iterable(words))
                c = np.fromiter(map(code.get, every, repeat(other)), np.int64, len(every))
                length = np.fromiter(map(len, every), np.int64, len(every))
                text_no = np.repeat(np.arange(len(some)), n)
                which = np.bincount(text_no * (len(langs) + 1) + (c >> 32), minlength=len(some) * (len(langs) + 1)).reshape(len(some), -1)[:, : len(langs)]
                rank = np.sort((text_no << 32) | (c & 0xFFFFFFFF)) & 0xFFFFFFFF  # each text's in order, text by text
                sentences = np.array([len(SENTENCE.findall(texts[i])) for i in some])
                cover = [np.log(rank[starts + np.minimum(n, np.ceil(q * n).astype(np.int64)) - 1]) for q in SHARES]
                total = lambda x: np.add.reduceat(x, starts)
                rows.append(np.column_stack([n, total((c != other).astype(np.int64)), *cover, np.log(n / sentences), total(length) / n, total((length >= 9).astype(np.int64)) / n]))
                ids += [part[i][0] for i in some]
                hashes += [part[i][2] for i in some]
                tongue += [langs[i] for i in np.argmax(which, 1)]
            table = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(hashes, pa.int64()), *[pa.array(table[:, i].astype(np.int64)) for i in range(2)], pa.array(tongue, pa.string()), *[pa.array(table[:, i + 2]) for i in range(len(FEATURES))]], names=[id_col, "text_key", "n", "held", "lang", *FEATURES])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))).mapInArrow(f, f"`{id_col}` {kind}, text_key long, n long, held long, lang string, " + ", ".join(f"{x} double" for x in FEATURES))


def beyond_held(df: DataFrame, feats: DataFrame, ranks: DataFrame, vocabulary: dict[str, tuple[str, int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_key, COVER...) of the texts some of whose coverage ranks are those of words no worker holds: the exact ones, null where they are held.

    Only these texts' rare words are joined with their ranks; a text's are in order of rank as they stream by.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    deep = feats.where(F.ceil(F.lit(max(SHARES)) * F.col("n")) > F.col("held")).select(F.col(id_col).alias("_id"), F.col("text_key").alias("_h"), "n", "held").distinct()
    keyed = df.select(id_col, F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    texts = keyed.join(broadcast_if_small(deep), (F.col(id_col) == F.col("_id")) & (F.col("text_key") == F.col("_h"))).select(id_col, "text_key", "n", "held", "text").dropDuplicates([id_col, "text_key"])

    def f(batches):
        for b in batches:
            at, words, counts = [], [], []
            for i, text in enumerate(b.column(4).to_pylist()):
                c = Counter(w for w in words_of(plain(text).lower()) if w not in shared.value)
                at += [i] * len(c)
                words += c
                counts += c.values()
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(4)), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=[id_col, "text_key", "n", "held", "word", "c"])

    kind = df.schema[id_col].dataType.simpleString()
    rare = texts.mapInArrow(f, f"`{id_col}` {kind}, text_key long, n long, held long, word string, c long").join(ranks.select("word", "rank"), "word")
    run = Window.partitionBy(id_col, "text_key").orderBy("rank", "word").rowsBetween(Window.unboundedPreceding, 0)
    rare = rare.withColumn("_upto", F.col("held") + F.sum("c").over(run))
    need = lambda q: F.ceil(F.lit(q) * F.col("n"))
    return rare.groupBy(id_col, "text_key").agg(*[F.log(F.min(F.when((need(q) > F.col("held")) & (F.col("_upto") >= need(q)), F.col("rank")))).alias(f"cover{round(100 * q)}") for q in SHARES])


def _standard(feats: DataFrame) -> DataFrame:
    """Features less the mean of their language, in its standard deviations, with their squares as further ones."""
    moments = feats.groupBy("lang").agg(*[F.avg(x).alias(f"m_{x}") for x in FEATURES], *[F.stddev_pop(x).alias(f"s_{x}") for x in FEATURES])
    z = feats.join(F.broadcast(moments), "lang")  # one row a language
    z = z.select("*", *[F.when(F.col(f"s_{x}") > 1e-9, (F.col(x) - F.col(f"m_{x}")) / F.col(f"s_{x}")).otherwise(0.0).alias(f"z_{x}") for x in FEATURES])
    return z.select(*feats.columns, *[f"z_{x}" for x in FEATURES], *[(F.col(f"z_{x}") * F.col(f"z_{x}")).alias(f"q_{x}") for x in FEATURES])


def fit(labelled: DataFrame, level_col: str, ridge: float = 1e-3) -> dict[int, list[float]]:
    """Coefficients (constant first) of each level's linear discriminant, from one aggregate over the labelled rows."""
    xs = [f"z_{x}" for x in FEATURES] + [f"q_{x}" for x in FEATURES]
    pairs = [(a, b) for i, a in enumerate(xs) for b in xs[i:]]
    sums = labelled.groupBy(F.col(level_col).cast("int").alias("level")).agg(F.count("*").alias("n"), *[F.sum(x).alias(x) for x in xs], *[F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in pairs]).collect()  # one row a level
    if not sums:
        return {}
    total = sum(r["n"] for r in sums)
    mean = {r["level"]: np.array([r[x] for x in xs]) / r["n"] for r in sums}
    scatter = np.zeros((len(xs), len(xs)))
    for r in sums:
        second = np.zeros_like(scatter)
        for a, b in pairs:
            i, j = xs.index(a), xs.index(b)
            second[i, j] = second[j, i] = r[f"{a}*{b}"]
        scatter += second - r["n"] * np.outer(mean[r["level"]], mean[r["level"]])
    inverse = np.linalg.inv(scatter / total + ridge * np.eye(len(xs)))
    out = {}
    for r in sums:
        w = inverse @ mean[r["level"]]
        out[r["level"]] = [float(-0.5 * mean[r["level"]] @ w + np.log(r["n"] / total)), *map(float, w)]
    return out


def score(model: dict[int, list[float]]) -> Column:
    """The level whose discriminant is greatest; ties go to the easier one."""
    xs = [f"z_{x}" for x in FEATURES] + [f"q_{x}" for x in FEATURES]
    parts = []
    for level, (constant, *w) in sorted(model.items()):
        s = F.lit(constant)
        for x, c in zip(xs, w):
            s = s + F.col(x) * c
        parts.append(F.struct(s.alias("s"), F.lit(-level).alias("l")))
    return -(F.greatest(*parts) if len(parts) > 1 else parts[0])["l"]


def document_features(documents: DataFrame, wanted: DataFrame, size: int = HELD) -> DataFrame:
    """Standardised features of the ``wanted`` documents, with ranks counted over all ``documents``; ``size`` changes where ranks are looked up, not what they are."""
    ranks = stored(ranked_vocabulary(word_counts(documents)))
    words = {r["word"]: (r["lang"], r["rank"]) for r in ranks.where(F.col("rank") <= size).toLocalIterator()}  # at most ``size`` a language
    feats = stored(features(wanted, words, size))
    exact = beyond_held(wanted, feats, ranks, words)
    covers = [x for x in FEATURES if x.startswith("cover")]
    joined = feats.join(exact.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_h"), *[F.col(x).alias(f"_{x}") for x in covers]), (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_h")), "left")
    return _standard(joined.select("doc_id", "lang", *[F.coalesce(f"_{x}", x).alias(x) if x in covers else F.col(x) for x in FEATURES]))


def reading_levels(documents: DataFrame, labels: DataFrame, min_chars: int = 250, skip: tuple[str, ...] = ("listing", "log"), size: int = HELD) -> DataFrame:
    """(doc_id, reading_level) of every unlabelled document of at least ``min_chars`` characters whose kind is not skipped.

    Documents without a word (markup or digits only) get the level of most labelled rows. Null kinds are not skipped,
    null n_chars counts as 0; labels that are null, or whose document is missing, are ignored; without any usable label
    there is nothing to calibrate by and the result is empty. Repeated rows of a document give one row.
    """
    docs = documents.select("doc_id", "text", "lang", "n_chars", "doc_kind")
    known = labels.where(F.col("reading_level").isNotNull()).select("doc_id", F.col("reading_level").cast("int").alias("reading_level"))
    hint = broadcast_if_small(known)
    kind_ok = ~F.coalesce(F.col("doc_kind"), F.lit("")).isin(*skip)
    marked = docs.where(F.col("doc_id").isNotNull()).join(hint.select(F.col("doc_id").alias("_id")).distinct().withColumn("_known", F.lit(True)), F.col("doc_id") == F.col("_id"), "left")
    target = F.col("_known").isNull() & (F.coalesce("n_chars", F.lit(0)) >= min_chars) & kind_ok
    wanted = marked.where(target | F.col("_known"))
    z = document_features(docs, wanted, size)
    model = fit(z.join(hint, "doc_id"), "reading_level")
    if not model:
        return documents.sparkSession.createDataFrame([], "doc_id long, reading_level int")
    common = known.groupBy("reading_level").count().orderBy(F.desc("count"), "reading_level").first()[0]
    scored = z.join(hint.select(F.col("doc_id").alias("_k")).distinct(), F.col("doc_id") == F.col("_k"), "left_anti").select("doc_id", score(model).alias("reading_level"))
    ids = marked.where(target).select("doc_id").distinct()
    return ids.join(scored.groupBy("doc_id").agg(F.min("reading_level").alias("reading_level")), "doc_id", "left").select("doc_id", F.coalesce("reading_level", F.lit(common)).cast("int").alias("reading_level"))
