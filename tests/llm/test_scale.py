"""Hot keys, other splits, other sizes and clashing names give the same results."""

import collections
import hashlib

import pytest

from chemprobe.llm import exact_dedup, ngram_join, quality_rules, suffix_dedup
from tests.llm.conftest import SCHEMA, stored
from tests.llm.test_documents import brute_components, brute_spans, counted


def wanted_spans(rows):
    return counted((i, *x) for (i, *_), x in zip(rows, brute_spans([(t or "").encode() for _, t, *_ in rows])))


@pytest.fixture()
def many_files(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(12).write.parquet(f"{tmp_path}/many.parquet")
    return spark.read.parquet(f"{tmp_path}/many.parquet")


@pytest.fixture()
def resplit(spark):
    """Changes how tables are cut to tasks, as another number of executors does."""
    keys = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "134217728"}
    before = {k: spark.conf.get(k, None) for k in keys}

    def change():
        for k, v in keys.items():
            spark.conf.set(k, v)

    yield change
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_repeats_when_the_splits_change(spark, rows, many_files, resplit):
    spark.conf.set("spark.sql.files.minPartitionNum", "12")
    digest, left = suffix_dedup.digest(many_files), suffix_dedup.remove_repeats(many_files)
    copies = exact_dedup.keep_first_copies(many_files)
    before = many_files.rdd.getNumPartitions()
    resplit()
    assert spark.read.parquet(*many_files.inputFiles()).rdd.getNumPartitions() != before
    assert counted(map(tuple, digest.collect())) == wanted_spans(rows)
    kept = {(i, x[3]) for (i, *_), x in zip(rows, brute_spans([(t or "").encode() for _, t, *_ in rows]))}
    for r in left.collect():
        assert (r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) in kept
    assert copies.count() == len({"".join((t or "").split(" ")).translate(str.maketrans("", "", "\t\n\x0b\x0c\r")) for _, t, *_ in rows})


def test_repeats_of_a_table_that_is_not_stored(spark, rows, docs):
    shuffled = docs.repartition(5).unionByName(docs.limit(0))
    assert counted(map(tuple, suffix_dedup.digest(shuffled).collect())) == wanted_spans(rows)


@pytest.mark.parametrize("runs", [(24, 1), (1,), (5, 1)])
def test_hot_anchors(spark, monkeypatch, runs):
    """A phrase amid different texts, shorter and longer than a passage, with exact and near copies."""
    import random

    from tests.llm.conftest import prose

    rng = random.Random(9)
    short, long = prose(rng, 20)[:150], prose(rng, 60)[:260]
    rows = [(i, prose(rng, 45) + (short if i % 2 else long) + prose(rng, 45), "en", "a") for i in range(30)]
    rows += [(100 + i, rows[4][1], "en", "a") for i in range(5)] + [(200, "ab" * 700, "en", "a"), (201, long + long, "en", "a")]
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "RUNS", runs)
    assert counted(map(tuple, suffix_dedup.digest(stored(spark, rows)).collect())) == wanted_spans(rows)


def test_hubs(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUB", 1)
    once = list({r[0]: r for r in rows if r[0] is not None}.values())
    near = once[6][1].split()
    once += [(1000 + k, " ".join([*near[:-1], f"end{k}"]), "en", "a") for k in range(12)]
    sets, find = brute_components(once)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_classes(stored(spark, once)).collect()}
    assert got == {i: find(i) for i, *_ in once}


def junk(i, n):
    return " ".join(f"word{i}x{k}" + "***" * (k % 9 < n) for k in range(80))


def test_thresholds_follow_each_source(spark):
    """What is a tail in one source is the habit of another."""
    rows = [(i, junk(i, 0), "en", "prose") for i in range(200)] + [(1000 + i, junk(i, 2), "en", "code") for i in range(200)]
    rows += [(2000 + i, junk(i, 2), "en", "prose") for i in range(9)] + [(3000 + i, junk(i, 9), "en", "code") for i in range(9)]
    kept = {r["doc_id"] for r in quality_rules.judge(stored(spark, rows)).where("kept").collect()}
    assert kept == set(range(200)) | set(range(1000, 1200))


def test_no_size_switches_the_rule(spark):
    """A group's threshold moves with its own rows, be they few or many."""
    wide = [(i, junk(i, i % 3), "en", "wide") for i in range(300)]
    tops = []
    for n in (20, 49, 50, 51, 200):
        rows = wide + [(1000 + i, junk(i, 0), "en", "own") for i in range(n)] + [(5000, junk(1, 1), "en", "own")]
        judged = quality_rules.judge(stored(spark, rows)).where("doc_id = 5000").first()
        tops.append(judged["kept"])
    assert tops == sorted(tops, reverse=True) and tops[1] == tops[2] == tops[3]


NAMES = ["__w", "__l", "__lines", "__capitals", "__r_symbols", "__glang", "__gsource", "__crc", "__id", "__of", "__sha", "__row", "__left", "_rid", "_path", "_no", "_gone", "c0", "c1"]


@pytest.mark.parametrize("run", [quality_rules.keep_good, exact_dedup.keep_first_copies, ngram_join.keep_one_of_each, suffix_dedup.remove_repeats, quality_rules.judge], ids=lambda f: f.__name__)
def test_reserved_names_stay(spark, docs, tmp_path, run):
    odd = docs
    for c in NAMES:
        odd = odd.selectExpr("*", f"'as it was' AS `{c}`")
    odd.write.parquet(f"{tmp_path}/odd.parquet")
    out = run(spark.read.parquet(f"{tmp_path}/odd.parquet"))
    assert set(NAMES) <= set(out.columns)
    assert {tuple(r) for r in out.select(*NAMES).distinct().collect()} == {("as it was",) * len(NAMES)}
    same = collections.Counter(r["doc_id"] for r in run(docs).collect())
    assert collections.Counter(r["doc_id"] for r in out.collect()) == same


def test_ids_outside_the_vocabulary_are_refused():
    import numpy as np

    from chemprobe.llm import range_coder

    wide = np.array([0, 70_000, 123_456, 70_000], np.int64)
    (blob,) = range_coder.pack_blocks([(wide, [(0, 1, 4)])], 130_000)
    assert next(range_coder.unpack_blocks([blob]))[0].tolist() == wide.tolist()
    with pytest.raises(ValueError):
        range_coder.pack_blocks([(wide, [(0, 1, 4)])], 65_536)


def test_long_and_mixed_blocks(monkeypatch):
    """Blocks of several lanes, with runs, repeats of other lanes and noise; what repeats costs little."""
    import numpy as np

    from chemprobe.llm import range_coder

    rng = np.random.default_rng(4)
    phrase = rng.integers(0, 49408, 97)
    for ids in (np.tile(phrase, 300), rng.integers(0, 49408, 30000), np.repeat(rng.integers(0, 9, 300), 100), np.concatenate([rng.zipf(1.3, 20000) % 49408, np.full(9000, 49407)])):
        (blob,) = range_coder.pack_blocks([(ids, [(0, 0, len(ids))])], 49408)
        assert (next(range_coder.unpack_blocks([blob]))[0] == ids).all()
        if len(set(ids.tolist())) < 200:
            assert len(blob) < len(ids) / 4


def test_a_document_over_several_blocks(spark, monkeypatch, tmp_path):
    import numpy as np

    from chemprobe.llm import range_coder
    from tests.llm.test_documents import tokenizer

    path, t = tokenizer("word_bpe_49k.json")
    rows = [(1, "word and other words " * 9000, "en", "a"), (2, None, "en", "a"), (3, "end", "en", "a"), (3, "end", "en", "a")]
    range_coder.write_ids(stored(spark, rows), path, f"file://{tmp_path}/ids", 49408)
    got = range_coder.read_ids(spark, f"file://{tmp_path}/ids")
    import zlib

    want = []
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert counted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == counted(want)


def test_any_cut_of_a_text_gives_the_same_ids():
    import random

    from chemprobe.llm import bpe
    from tests.llm.test_documents import ODD, tokenizer

    path, t = tokenizer("byte_bpe_50k.json")
    coder, rng = bpe.transducer(path), random.Random(3)
    more = ["a" * 9000 + "<|endoftext|>" + "-" * 7000 + "'ll" + " " * 6000 + "x", "\n" * 8000, " " * 5000 + "<|endoftext|>  ", "-" * 5000 + "<|end", "1" * 9000 + "st", "é" * 6000 + " word", "\t " * 4000 + "y", " " + "中" * 5000 + "  <|endoftext|>"]
    signs = ["a", "b ", " ", "\n", "'", "'r", "e", "1", "-", "<|", "endoftext", "|>", "<|endoftext|>", "中", "\t", "word", " the"]
    more += ["".join(rng.choice(signs) for _ in range(rng.choice([5, 60, 3000]))) for _ in range(60)]
    for text in ODD + more:
        want = bpe.as_bytes(t.encode(text, add_special_tokens=False).ids)
        for step in (1 if len(text) < 400 else 997, 5000):
            assert b"".join(coder.parts(text, step)) == want, (text[:60], step)


def test_a_long_text_takes_constant_memory():
    """100 MB of words, then a word of 4 MB: the stream holds no more than a part of either."""
    from chemprobe.llm import bpe
    from tests.llm.test_documents import tokenizer

    path, t = tokenizer("byte_bpe_50k.json")
    coder = bpe.transducer(path)
    words = "streams of words, and of other words; " * 7000
    stream, held, n = bpe.TextStream(coder), 0, 0
    for _ in range(400):
        n += len(stream.push(words)) // 4
        held = max(held, len(stream.held))
    n += len(stream.finish()) // 4
    assert 400 * len(words) > 100_000_000 and held < 100
    one, two = (len(t.encode(words * k, add_special_tokens=False).ids) for k in (1, 2))
    assert n == one + 399 * (two - one)
    stream, inside = bpe.TextStream(coder), 0
    for _ in range(16):
        stream.push("ab" * 2000)
        inside = max(inside, len(stream.held) + (len(stream.open.held) if stream.open else 0))
    stream.finish()
    assert inside < 5 * coder.lookahead + 4000


def test_repeated_ids_do_not_swell_the_training_sample(spark):
    from chemprobe.llm import quality_classifier

    rows = [(i, f"text {i} " * 30, "en", "a") for i in range(40)] + [(3, f"copy {k}", "en", "a") for k in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    real = quality_classifier.train
    try:
        quality_classifier.train = lambda texts, y: seen.append((texts, y))
        quality_classifier.fit(stored(spark, rows), labels)
    finally:
        quality_classifier.train = real
    (texts, y), = seen
    assert len(texts) == len(set(texts)) <= 40 and sum("copy" in x for x in texts) <= 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_quality_on_held_out_labels(spark, sf):
    import os

    if not os.path.isdir(sf):
        pytest.skip("no tables")
    from chemprobe.llm import quality_classifier

    got = quality_classifier.op6_quality_classifier(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r["score"] for r in got if r["quality"] == 1], [r["score"] for r in got if r["quality"] == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(got) > 50 and auc > 0.95
