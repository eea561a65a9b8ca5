"""Tokens, packing and reading levels."""

import random

import pytest
from pyspark.sql import functions as F

from eventlake.llm import packing, reading, tokens

TEXTS = ["", None, "Hello world's  end\n\n", "a" * 5000, "naïve Zürich — 東京 🎸🎶 ½ Ⅷ १२", " \t\n ", "it'll <|endoftext|> we've", "\x1c\x85 x", "é" * 300 + " 12345678901234567890", "Привет, мир"]


def test_ids_equal_the_public_tokenizer(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(" \n\tab'sré½中😀́.,-12Zz") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in tokens.encode(df).collect()}
    assert [got[i] for i in range(len(texts))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(df).collect()}
    assert all(counts[i] == len(got[i]) for i in got)


def test_ids_of_repeats_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert tokens.encode(df).count() == 3
    assert tokens.encode(df.limit(0)).collect() == []


def test_merge_is_the_plain_algorithm():
    import base64

    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aaaa": 260}
    file = b"\n".join(base64.b64encode(k) + b" %d" % v for k, v in ranks.items())
    ids = tokens.Ids(file)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                return tuple(ranks[p] for p in parts)
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    for _ in range(500):
        s = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
        assert ids[s] == plain(s.encode())


def test_sum_of_squares_is_the_definition():
    rng = random.Random(2)
    sizes, capacity = [rng.randint(1, 10) for _ in range(300)], 10
    fills: list[int] = []
    for s, at in zip(sizes, packing.sum_of_squares(sizes, capacity)):
        squares = lambda f: sum(f.count(x) ** 2 for x in range(1, capacity))
        options = [squares([*fills[:i], f + s, *fills[i + 1 :]]) for i, f in enumerate(fills) if f + s <= capacity] + [squares([*fills, s])]
        if at == len(fills):
            fills.append(0)
        fills[at] += s
        assert fills[at] <= capacity and squares(fills) == min(options)


@pytest.mark.parametrize("group", [50_000, 40])
def test_packing_keeps_every_token(spark, group):
    rng = random.Random(4)
    data = [(i, rng.choice([0, 1, 5, 40, 99, 100, 101, 250, rng.randint(1, 100)]), "x") for i in range(400)] + [(1000, None, "x"), (None, 5, "x")]
    df = spark.createDataFrame(data, "doc_id long, n_tokens int, container_id string")
    rows = packing.pack(df, capacity=100, group=group).collect()
    assert sorted(r.doc_id for r in rows if r.piece_no == 0) == sorted(d[0] for d in data if d[0] is not None)
    sums, fill = {}, {}
    for r in rows:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.n_tokens
        assert (r.container_id is None) == (r.n_tokens == 0)
        if r.container_id is not None:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
    assert all(sums[i] == (n or 0) for i, n, _ in data if i is not None)
    assert max(fill.values()) <= 100 and sum(fill.values()) / 100 / len(fill) > 0.93
    assert all(len([r for r in rows if r.doc_id == i]) == 1 for i, n, _ in data if i is not None and (n or 0) <= 100)
    assert {tuple(r) for r in rows} == {tuple(r) for r in packing.pack(df.repartition(3), capacity=100, group=group).collect()}


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).collect() == []


EASY = "The cat sat. She ran home. He is glad."
HARD = "The phenomenology of institutional heterogeneity presupposes irreconcilable epistemological commitments notwithstanding considerable methodological reconsideration within deterritorialised marketplaces."


def documents(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        level = i % 2
        text = " ".join(rng.choice([HARD, HARD + " Further."] if level else [EASY, EASY + " It was fun."]) for _ in range(rng.randint(9, 14)))
        rows.append((i, text, "en", len(text), "bio", "clash"))
    rows += [(500, EASY * 10, None, 500, "listing", ""), (501, EASY, "en", 40, "bio", ""), (502, None, "en", 900, None, ""), (503, HARD * 3, "xx", 900, None, ""), (504, "<p>123 456</p>", "en", 300, "bio", ""), (1, "x", "en", 300, "bio", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, doc_kind string, reading_level string")


def test_levels_are_told_apart(spark):
    labels = spark.createDataFrame([(i, 1 + 3 * (i % 2), "a") for i in range(40)] + [(41, None, "a"), (9999, 2, "a")], "doc_id long, reading_level int, rater string")
    got = {r.doc_id: r.reading_level for r in reading.reading_levels(documents(spark), labels).collect()}
    assert set(got) == {*range(40, 120), 502, 503, 504}
    assert all(got[i] == 1 + 3 * (i % 2) for i in range(40, 120)) and got[503] == 4
    assert got[502] in (1, 4) and got[504] in (1, 4)


def test_levels_without_labels_or_documents(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, reading_level int, rater string")
    assert reading.reading_levels(docs, none).collect() == []
    assert reading.reading_levels(docs.limit(0), none).collect() == []


def test_vocabulary_ranks(spark):
    docs = spark.createDataFrame([("b a a", "en"), ("a b Ã¼ber", "en"), ("chat chat a", "fr"), (None, "fr"), ("d", None)], "text string, lang string")
    ranks = {(r["word"], r["lang"]): r["rank"] for r in reading.ranked_vocabulary(reading.word_counts(docs)).collect()}
    assert ranks[("a", "en")] == 1 and ranks[("b", "en")] == 2 and ranks[("über", "en")] == 3 and ranks[("chat", "fr")] == 1 and ranks[("d", "und")] == 1
    top = reading.ranked_vocabulary(reading.word_counts(docs), size=1).count()
    assert top == 3


def test_ranks_are_the_same_wherever_they_are_held(spark):
    """Ranks of words no worker holds are joined to the texts that reach them: the features do not depend on how many are held."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{''.join(chr(97 + int(c)) for c in str(int(rng.paretovariate(0.7)) % 4000))}" for _ in range(rng.randint(5, 120))) + ".", "en") for i in range(80)] + [(0, "other text of the same id", "en"), (90, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = lambda size: sorted((r.doc_id, r.sentence, *(round(r[x], 9) for x in reading.FEATURES)) for r in reading.document_features(docs, docs, size).collect())
    whole = held(50_000)
    assert len(whole) == 81 and held(3) == whole and held(40) == whole


def test_words_without_the_pattern():
    """The table and blanks give the pattern's words, wherever apostrophes, digits and marks stand."""
    rng = random.Random(3)
    texts = ["", "'", "l'été d’hier ''a''b'", "x_1y²٣Ⅷ ½ß İ漢😀ªn't'"] + ["".join(rng.choice("aé'’ _1²ßИ漢\n.٣Ⅷ😀'") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert all(reading.words_of(t) == reading.WORD.findall(t) for t in texts)


def test_damaged_text():
    from eventlake.llm.clean import plain

    assert plain("rÃ\xade mucho <b>ya</b>").split() == ["ríe", "mucho", "ya"]
    assert plain("improvisаtory аesthetic") == "improvisatory aesthetic" and plain("Привет мир") == "Привет мир"
    assert plain("5 < 6 and Ãx") == "5 < 6 and Ãx"


def test_counts_are_complete(spark):
    docs = spark.range(3000).select(F.concat(F.lit("w"), (F.col("id") % 7).cast("string"), F.lit(" common")).alias("text"), F.lit("en").alias("lang"))
    counts = {r["word"]: r["n"] for r in reading.word_counts(docs).collect()}
    assert counts["common"] == 3000 and counts["w"] == 3000
