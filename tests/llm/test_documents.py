"""Each operator over documents against brute force, on rows with every odd case."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from chemprobe.llm import bpe, exact_dedup, ngram_join, packing, quality_classifier, quality_rules, range_coder, sharding, suffix_dedup

WHITE = "[\x20\x09-\x0d]"


def words_of(text):
    return [w for w in re.split(WHITE + "+", text or "") if w]


def ids_of(df, key="doc_id"):
    return sorted((r[key] for r in df.select(key).collect()), key=lambda x: (x is None, x))


def counted(rows):
    return collections.Counter(rows)


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    return path, Tokenizer.from_file(path)


def test_quality_measures(docs, rows):
    def want(i, text):
        w = words_of(text)
        at = collections.defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k : k + 3])].append(k)
        repeated = {j for v in at.values() if len(v) > 1 for k in v for j in (k, k + 1, k + 2)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        return (i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)

    got = quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert counted(map(tuple, got)) == counted(want(i, t) for i, t, _, _ in rows)


def test_quality_verdict(spark, docs):
    got = quality_rules.judge(docs).where("kept AND base_failed").count()
    assert got == 0
    rng = __import__("random").Random(1)
    clean = [(i, " ".join(f"w{rng.random():.5f}"[1:] + "abc" for _ in range(80)), "en", "s") for i in range(80)]
    junk = [(100 + i, " ".join(f"a{i}b{k}***" for k in range(80)), "en", "s") for i in range(8)]
    from tests.llm.conftest import stored

    kept = {r["doc_id"] for r in quality_rules.judge(stored(spark, clean + junk)).where("kept").collect()}
    assert kept == {i for i, *_ in clean}


def test_sketches_merge(docs):
    from pyspark.sql import functions as F

    m = quality_rules.measures(docs).withColumns({f"__r_{k}": v for k, v in quality_rules._rates().items()})
    whole = quality_rules.sketches(m, []).orderBy("measure", "bucket").collect()
    parts = quality_rules.sketches(m, ["lang"]).groupBy("measure", "bucket").agg(F.sum("n").alias("n")).orderBy("measure", "bucket").collect()
    assert whole == parts


def test_sharding(docs, rows):
    got = sharding.shard_manifest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["shard"] < 8 and r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert counted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == counted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r["shard"] for r in got if r["doc_id"] == 3}) == 1


def test_sharding_weights(spark):
    from pyspark.sql import functions as F

    n = spark.range(20000).withColumnRenamed("id", "doc_id")
    shares = {r["shard"]: r["count"] / 20000 for r in sharding.shard(n, weights=[1, 2, 1, 0]).groupBy("shard").count().collect()}
    assert shares.keys() == {0, 1, 2} and abs(shares[1] - 0.5) < 0.02
    moved = sharding.shard(sharding.shard(n), weights=[1.0] * 9, column="more").where("shard <> more").groupBy("more").agg(F.count("*").alias("k")).collect()
    assert [r["more"] for r in moved] == [8] and abs(moved[0]["k"] / 20000 - 1 / 9) < 0.01


def test_exact_dedup(docs, rows):
    norm = [re.sub(WHITE, "", t or "") for _, t, *_ in rows]
    groups = collections.defaultdict(list)
    for (i, t, *_), x in zip(rows, norm):
        groups[x].append((-len(t or ""), i is None, i or 0, i))
    want = counted((i, min(groups[x])[3], len(groups[x]), hashlib.sha256(x.encode()).hexdigest()) for (i, *_), x in zip(rows, norm))
    got = exact_dedup.mark_duplicates(docs).collect()
    assert counted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_dedup.keep_first_copies(docs).count() == len(groups)


def test_block_names_of_long_texts(spark):
    from tests.llm.conftest import stored

    long = ["".join(chr(97 + (k * k + s) % 23) for k in range(40000)) for s in (1, 1, 2)]
    long.append(long[0][:-1] + "#")
    got = exact_dedup.mark_duplicates(stored(spark, [(i, t, "en", "a") for i, t in enumerate(long)])).collect()
    assert {(r["doc_id"], r["keep_id"]) for r in got} == {(0, 0), (1, 0), (2, 2), (3, 3)}


def brute_components(rows):
    sets = {}
    for k, (i, t, *_) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = [k for k, (i, *_) in enumerate(rows) if i is not None and sets[k]]
    for a in keys:
        for b in keys:
            x = len(sets[a] & sets[b])
            if a < b and 100 * x >= 80 * (len(sets[a]) + len(sets[b]) - x):
                p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                root[q] = p
    return sets, find


def test_ngram_join(spark, rows):
    from tests.llm.conftest import stored

    once = list({r[0]: r for r in rows if r[0] is not None}.values())
    sets, find = brute_components(once)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_classes(stored(spark, once)).collect()}
    assert got == {i: (len(sets[k]), find(i)) for k, (i, *_) in enumerate(once)}
    assert ngram_join.keep_one_of_each(stored(spark, once)).count() == len({find(i) for i, *_ in once})


def test_ngram_join_repeated_rows(docs, rows):
    got = ngram_join.link_classes(docs).collect()
    assert len(got) == len(rows)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]


@pytest.mark.parametrize("n", [1, 4, 5, 9, 30, 200])
def test_pigeonhole_finds_all_neighbours(n):
    """Whatever elements differ, the larger set's cheapest credits meet the other's signatures."""
    rng = np.random.default_rng(n)
    for _ in range(40):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        most = (2 * len(a)) // 9
        drop = rng.integers(0, most // 2 + 1)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)]))
        x = len(np.intersect1d(a, b))
        if 100 * x < 80 * (len(a) + len(b) - x):
            continue
        level = ngram_join.levels_of(max(len(a), len(b)))[0]
        sa, sb = ngram_join.signatures(a), ngram_join.signatures(b)
        own = lambda s: {int(v) >> 2 for v in s if (int(v) >> 2 & 63) == level and int(v) & 3 != 1}
        differ = len(own(sa) - own(sb))
        assert differ <= ngram_join.need_of(max(len(a), len(b)), level) - 1
        pa, pb = (np.array(ngram_join._parity(ngram_join._segments(s, level)[0], level)) for s in (a, b))
        assert sum(int(v & (2**64 - 1)).bit_count() for v in (pa ^ pb).tolist()) <= len(a) + len(b) - 2 * x


def brute_spans(texts, length=200):
    seen = collections.Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    for b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        yield len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()


def test_suffix_dedup(docs, rows):
    want = counted((i, *x) for (i, *_), x in zip(rows, brute_spans([(t or "").encode() for _, t, *_ in rows])))
    assert counted(map(tuple, suffix_dedup.digest(docs).collect())) == want
    cut = suffix_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)


def test_two_stage_order():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice([97, 98], 60)) for _ in range(6)] + [b"aaaa" * 20, b"ba" * 30, b"z"]
    size = np.array([len(x) for x in texts])
    t = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum(size) - size
    got = suffix_dedup.two_stage_order(t, off, size, size, np.ones(len(texts), bool), 200)
    suffixes = [x[k:] for x in texts for k in range(len(x))]
    assert sorted(got.tolist()) == list(range(len(suffixes)))
    ordered = [suffixes[k] for k in got]
    assert ordered == sorted(suffixes)


def test_packing(docs, rows):
    path, t = tokenizer("byte_bpe_50k.json")
    got = packing.pack(docs, path).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    want = collections.Counter()
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for s in range(0, len(ids), 1024):
            part = np.array(ids[s : s + 1024], "<u4").tobytes()
            want[(i, s, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert counted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(0)
    sizes, demand = np.unique(-(-rng.integers(1, 1024, 20000) // 8), return_counts=True)
    chosen = packing.plan(sizes, demand, 128)
    assert (sum(c * p for p, c in chosen) == demand).all()
    assert all(p @ sizes <= 128 for p, _ in chosen)
    assert sum(c for _, c in chosen) <= 1.01 * (sizes @ demand) / 128 + 2
    assert packing.plan(np.array([], int), np.array([], int), 128) == []


def test_bpe_round_trip(docs, rows):
    path, t = tokenizer("byte_bpe_50k.json")
    want = collections.Counter()
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert counted(map(tuple, bpe.round_trip(docs, path).collect())) == want
    back = bpe.decode(bpe.encode(docs, path), path)
    assert counted((r["doc_id"], r["text"]) for r in back.collect()) == counted((i, t or "") for i, t, *_ in rows)


ODD = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "  two  blanks ", "\n\n x\t\ty", "it's we'll THEY'D", "a b c\x1cd\x85e", "́ é", "ΟΔΟΣ ΑΣ", "-" * 4000, "thethe" * 900, "中" * 3000, "0123456789" * 30, "word, word. word,. ,word"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(name):
    from chemprobe.llm._tokens import library_encoder

    path, t = tokenizer(name)
    want = [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in ODD]
    assert library_encoder(path)(ODD) == want
    if name.startswith("byte"):
        assert bpe.transducer(path).encode(ODD) == want


def test_transducer_streams_in_constant_memory():
    path, t = tokenizer("byte_bpe_50k.json")
    coder = bpe.transducer(path)
    assert 10 < coder.lookahead < 5000
    rng = np.random.default_rng(2)
    for letters in (b"-", b"ab", b"aeinorst", b"=-#*"):
        text = bytes(rng.choice(list(letters), 6000)).decode()
        if not text.isalpha() and letters.isalpha():
            continue
        want = t.encode(text, add_special_tokens=False).ids
        assert list(coder.stream(text[k : k + 137].encode() for k in range(0, len(text), 137))) == want


def test_decoder_keeps_unfinished_characters():
    path, t = tokenizer("byte_bpe_50k.json")
    ids = np.array(t.encode("中文😀é" * 9, add_special_tokens=False).ids)
    assert "".join(bpe.transducer(path).decode(ids, step=1)) == "中文😀é" * 9


def test_token_files(spark, docs, rows, tmp_path):
    path, t = tokenizer("word_bpe_49k.json")
    folder = f"file://{tmp_path}/ids"
    range_coder.write_ids(docs, path, folder, 49408)
    got = range_coder.read_ids(spark, folder).orderBy("start").collect()
    encoded = {}
    for _, text, *_ in rows:
        encoded[text] = t.encode(text or "", add_special_tokens=False).ids + [2]
    want = counted((i, len(encoded[x]), zlib.crc32(np.array(encoded[x], "<u4").tobytes())) for i, x, *_ in rows)
    assert counted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert order == sorted(order)


def test_range_coder_blocks():
    rng = np.random.default_rng(1)
    ids = [rng.zipf(1.4, n) % 49408 for n in (1, 700, 5000)] + [np.full(5000, 7), rng.integers(0, 49408, 300)]
    blocks = [(x.astype(np.int64), [(k, k if k else None, len(x))]) for k, x in enumerate(ids)]
    blobs = range_coder.pack_blocks(blocks, 49408)
    for (x, seg), (y, back) in zip(blocks, range_coder.unpack_blocks(blobs)):
        assert (x == y).all() and seg == back
    assert len(blobs[3]) < 200
    broken = bytearray(blobs[2])
    broken[-40] ^= 255
    with pytest.raises(ValueError):
        list(range_coder.unpack_blocks([bytes(broken)]))
    a, b = rng.bytes(1000), rng.bytes(77)
    assert range_coder.crc32_combine(zlib.crc32(a), zlib.crc32(b), 77) == zlib.crc32(a + b)


def test_quality_classifier(spark):
    import random

    from tests.llm.conftest import prose, stored

    rng = random.Random(4)
    good = [(i, prose(rng, 80), None, None) for i in range(150)]
    bad = [(200 + i, prose(rng, 80).upper().replace(" ", "!! "), None, None) for i in range(60)] + [(300 + i, f"{rng.choice('abc')}x{i} " * 60, None, None) for i in range(60)]
    docs = stored(spark, good + bad + [(900, None, None, None), (901, "", None, None)])
    labels = spark.createDataFrame([(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()
    assert len(got) == 272 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert sum(r["predicted"] == (r["doc_id"] < 200) for r in held) >= 0.95 * len(held)
    assert quality_classifier.fit(docs, labels.limit(0)).offset == 0.0


RUNS = {
    "quality": quality_rules.keep_good,
    "exact": exact_dedup.keep_first_copies,
    "near": ngram_join.keep_one_of_each,
    "suffix": suffix_dedup.remove_repeats,
    "shard": lambda d: sharding.shard(d.drop("shard")),
}


@pytest.mark.parametrize("name", RUNS)
def test_other_columns_stay(name, clashing, docs):
    out = RUNS[name](clashing)
    assert set(clashing.columns) <= set(out.columns)
    extra = [c for c in clashing.columns if c not in docs.columns and c != "shard"]
    assert {tuple(r) for r in out.select(*[f"`{c}`" for c in extra]).distinct().collect()} == {("kept as it was",) * len(extra)}
    assert counted(ids_of(out)) == counted(ids_of(RUNS[name](docs)))


def test_empty_tables(spark, empty, tmp_path):
    path, _ = tokenizer("byte_bpe_50k.json")
    for f in RUNS.values():
        assert f(empty).count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert sharding.shard_manifest(empty).count() == 0
    assert exact_dedup.mark_duplicates(empty).count() == 0
    assert ngram_join.link_classes(empty).count() == 0
    assert suffix_dedup.digest(empty).count() == 0
    assert packing.pack(empty, path).count() == 0
    assert bpe.round_trip(empty, path).count() == 0
    range_coder.write_ids(empty, path, f"file://{tmp_path}/none", 50257)
    assert range_coder.read_ids(spark, f"file://{tmp_path}/none").count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.score(empty, quality_classifier.fit(empty, labels)).count() == 0


def test_lists_keep_empty_segments_one_deletion_away():
    import random

    import pandas as pd

    rng, met = random.Random(5), 0
    for _ in range(400):
        words = [f"w{rng.random()}" for _ in range(23)]
        texts = [" ".join(words), " ".join(words[:-1])]
        a, b = (ngram_join.shingle_set(t) for t in texts)
        for level in set(ngram_join.levels_of(len(a))) & set(ngram_join.levels_of(len(b))):
            if (ngram_join._segments(a, level)[2][0], ngram_join._segments(b, level)[2][0]) == (1, 0):
                met += 1
                blobs = pd.concat(ngram_join._blob_maker(1)(iter([pd.DataFrame({"text": texts})])))
                lists = ngram_join._lists(blobs)
                at = lists[(lists["level"] == level) & (lists["seg"] == 0)]
                assert set(at["kind"]) == {ngram_join._DELETED, ngram_join._EMPTY} and at["h1"].nunique() == 2
    assert met
