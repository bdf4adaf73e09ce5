"""The training-data operators against brute force, on small tables with nulls, empty texts, ties and repeated rows."""

import bisect
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cogwright.llm import chroma, hyperminhash, licenses, linededup, mixing, packing, quality, revisits, simhash, suffixdedup
from cogwright.llm.common import materialize, range_cuts, range_of
from cogwright.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, sub string, n int"


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def rows():
    base = words(1, 120)
    near = base[:]
    near[60] = "other"
    shared = " ".join(words(9, 40))
    texts = [
        " ".join(base), " ".join(near), " ".join(base), None, "", "one", "one two", "a\nb\nc\nd", "x\na\nb\nz\n\n", "ab" * 300, "é" * 150,
        "start " + shared + " end", "begin " + shared + " fin\nAnd é", " ".join(words(3, 5000)), "Released under the MIT License.\n" + shared, "!!! " * 30,
    ]
    out = [(i * 7 % 64, t, "en", None if i % 5 == 4 else f"s{i % 3}", len(t or ""), "k", "s", 1) for i, t in enumerate(texts)]
    return out + [(None, "null id text here", None, "s1", 5, None, None, None), (None, "another null id", "de", None, 3, None, None, None), out[0], (out[1][0], "same id, other text", "en", "s2", 4, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return materialize(spark.createDataFrame(rows(), SCHEMA).repartition(3), "docs")


@pytest.fixture(scope="module")
def unique(spark):
    return materialize(spark.createDataFrame([r for i, r in enumerate(rows()) if r[0] is not None and i < 16], SCHEMA), "unique")


@pytest.fixture(scope="module")
def empty(spark):
    return materialize(spark.createDataFrame([], SCHEMA), "empty")


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    out = packing.pack_documents(docs).toPandas().sort_values(["sequence_id", "offset"])
    ends = out.groupby("sequence_id")["length"].cumsum()
    assert (ends <= 1024).all() and (ends - out["length"] == out["offset"]).all()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows())
    assert out["length"].sum() == total
    assert packing.encode(["a<|endoftext|>b", "Zwölf 世界 \n\n x"], "byte_bpe_50k.json") == [tok.encode(t, add_special_tokens=False).ids for t in ("a<|endoftext|>b", "Zwölf 世界 \n\n x")]
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 65, size=300) if seed % 2 else rng.integers(15, 40, size=200)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True), strict=True)}
    runs, fixed = packing.plan_packing(histogram, 64)
    back: dict[int, int] = {}
    for r in runs:
        assert 0 < sum(r.lengths) <= 64 and r.times > 0
        for x in r.lengths:
            back[x] = back.get(x, 0) + r.times
    assert back == histogram
    bins: list[int] = []
    for x in sorted(sizes, reverse=True):  # first-fit decreasing
        for i, b in enumerate(bins):
            if b + x <= 64:
                bins[i] += x
                break
        else:
            bins.append(int(x))
    assert sum(r.times for r in runs) <= len(bins)


def test_suffix_dedup(docs, unique, empty):
    def brute(texts, n):
        seen, out = set(), {}
        for key, t in sorted(texts):
            b = t.encode()
            gone = np.zeros(len(b), dtype=bool)
            for p in range(len(b) - n + 1):
                if b[p : p + n] in seen:
                    gone[p : p + n] = True
                seen.add(b[p : p + n])
            kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
            out[key] = (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
        return out

    want = brute([(r[0], r[1] or "") for r in unique.select("doc_id", "text").collect()], 40)
    for shard in (4_000_000, 500):  # the second one makes every shared passage heavy
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in suffixdedup.remove_repeats(unique, 40, shard).collect()}
        assert got == want
    assert suffixdedup.remove_repeats(docs, 40).count() == len(rows())
    assert suffixdedup.remove_repeats(empty, 40).count() == 0


def test_suffix_dedup_repeated_rows(spark):
    p, a, b, c = (" ".join(words(k, n)) for k, n in ((31, 60), (32, 15), (33, 15), (34, 15)))
    texts = [(3, f"{a} {p} {b}"), (3, f"{a} {p} {b}"), (5, f"{b} {p} {c}"), (1, f"{c} {c}"), (7, p), (7, p)]
    table = materialize(spark.createDataFrame(texts, "doc_id long, text string"), "repeated-rows")
    seen, want = set(), {}
    for key, t in sorted(set(texts)):
        raw = t.encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 39):
            if raw[i : i + 40] in seen:
                gone[i : i + 40] = [True] * 40
            seen.add(raw[i : i + 40])
        want[key] = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
    for shard in (4_000_000, 500):
        got = sorted((r.doc_id, bytes(r.kept)) for r in suffixdedup.remove_repeats(table, 40, shard).collect())
        assert got == sorted((k, want[k]) for k, _ in texts)


def test_suffix_array_and_kasai():
    rng = np.random.default_rng(0)
    s = rng.integers(0, 3, size=200).astype(np.int16)
    order, _ = suffixdedup.suffix_array(s)
    want = sorted(range(200), key=lambda i: s[i:].tolist())
    assert order.tolist() == want
    lcp = suffixdedup.kasai(s, order, np.array([0, 50, 120]), 12)
    for p in range(1, 200):
        a, b = s[order[p - 1] :].tolist(), s[order[p] :].tolist()
        k = 0
        while k < min(len(a), len(b), 12) and a[k] == b[k]:
            k += 1
        assert lcp[p] == k


def shingles(t, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def test_near_duplicates(spark, docs, empty):
    base = words(5, 100)
    many = [(i, " ".join(base[: i % 30] + [f"q{i % 7}"] + base[i % 30 :]) if i % 4 else " ".join(words(i, 50)), "en", "s", 0, None, None, None) for i in range(160)]
    table = materialize(spark.createDataFrame(many, SCHEMA), "many")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in hyperminhash.near_duplicates(table, 3, 85).collect()}
    sets = {r[0]: shingles(r[1], 3) for r in many}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: (len(sets[i]), root(i), i == root(i)) for i in sets}
    out = hyperminhash.near_duplicates(docs, 3, 85).toPandas()
    assert len(out) == len(rows()) and (out.loc[out.n_shingles == 0, "component_id"] == out.loc[out.n_shingles == 0, "doc_id"]).all()
    assert hyperminhash.near_duplicates(empty, 3, 85).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 32), (40, 30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 32: 30, 40: 30}


def test_sketch_numbers():
    assert hyperminhash.compress(np.array([1 << 63, 1], dtype=np.uint64)).tolist() == [0, 63 << 10]
    assert 0 < hyperminhash.collision_rate(1000, 1000) < 0.01
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    p = hyperminhash.parities([a, a[10:]]).view(np.uint64)
    assert np.bitwise_count(p[0] ^ p[1]).sum() <= 10


def test_simhash(docs, unique, empty):
    out = simhash.near_report(unique).toPandas().sort_values("doc_id").reset_index(drop=True)
    texts = [r.text or "" for r in unique.orderBy("doc_id").collect()]
    for i, r in out.iterrows():
        k = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - k] + texts[(i + 1) % len(texts)][:k]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(texts[i])
        if edited == texts[i]:
            assert r.near_edited == 1.0
    prints = [int(f, 16) for f in out.fingerprint]
    for i, r in out.iterrows():
        if r.doc_id % 50 == 0:
            assert r.n_within == sum((p ^ prints[i]).bit_count() <= 3 for p in prints) - 1
    assert simhash.near_report(docs).count() == len(rows())
    assert simhash.near_report(empty).count() == 0


def test_search_grows_slower_than_the_table(spark):
    """Fingerprints that a query meets under its keys, counted at two sizes: ten times the table is far from ten times as many."""
    from pyspark.sql import functions as F

    met = []
    for n in (3_000, 30_000):
        prints = materialize(spark.range(n).select(F.xxhash64("id").alias("hi"), F.xxhash64("id", F.lit(1)).alias("lo")), "prints")
        plan = simhash.block_plan(20, n)
        pairs = simhash.probes(prints.limit(60), plan).select("table", "key").join(simhash.block_tables(prints, plan), ["table", "key"]).count()
        met.append(pairs / 60)
        assert pairs / 60 < 1.3 * simhash.search_cost(plan, n)
    assert met[1] < 5 * met[0]
    costs = [simhash.search_cost(simhash.block_plan(20, n), n) for n in (10**5, 10**6, 10**7, 10**8, 10**9)]
    assert all(b < 6 * a for a, b in zip(costs[:-1], costs[1:], strict=True))


def test_within_radius(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(128) for _ in range(60)]
    values += [v ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) for v in values]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    prints = materialize(spark.createDataFrame([(signed(v >> 64), signed(v & (2**64 - 1))) for v in set(values)], "hi long, lo long"), "prints")
    for radius in (1, 2, 3, 5):
        got = simhash.within_radius(prints, prints, radius)
        want = sum((a ^ b).bit_count() <= radius for a in set(values) for b in set(values))
        assert got.count() == got.distinct().count() == want


def test_within_wide_radius(spark):
    rng = random.Random(4)
    near = [0, 2**128 - 1, *(rng.getrandbits(128) for _ in range(30))]
    values = set(near)
    for v in near:
        for n in (1, 6, 8, 9, 19, 20, 21, 22, 30):
            values.add(v ^ sum(1 << b for b in rng.sample(range(128), n)))
    for plan in (simhash.block_plan(r) for r in (7, 8, 20, 21, 23)):  # one bit beyond every block's slack
        values.add(sum(1 << (127 - a - i) for a, _, slack in plan for i in range(slack + 1)))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    prints = materialize(spark.createDataFrame([(signed(v >> 64), signed(v & (2**64 - 1))) for v in values], "hi long, lo long"), "prints")
    for radius in (7, 8, 20, 23):
        got = simhash.within_radius(prints, prints, radius)
        want = sum((a ^ b).bit_count() <= radius for a in values for b in values)
        assert got.count() == got.distinct().count() == want


def test_near_copies_within(spark):
    rng = random.Random(6)
    texts = []
    for k in range(40):  # a text of 400 words, and a copy with ten words replaced: about 0.78 of the five-word shingles
        own = words(100 + k, 400, 5000)
        copy = own[:]
        for i in rng.sample(range(400), 10):
            copy[i] = f"new{k}x{i}"
        texts += [(50 * k, " ".join(own)), (50 * k + 1, " ".join(copy))]
    table = materialize(spark.createDataFrame(texts, "doc_id long, text string"), "planted")
    tight, wide = (simhash.near_report(table, r).filter("n_within > 0").count() for r in (simhash.RADIUS, simhash.NEAR_RADIUS))
    print("recall of 40 planted near copies:", tight, wide)
    assert wide >= 39 > tight


def test_mixing(spark, docs, empty):
    thin = materialize(mixing.keyed(docs).select("_key", "_id", "_size", "_tie"), "thin")
    out = mixing.mix_report(thin).toPandas()
    assert len(out) == len(rows()) and (out["taken"] <= 3 * out["size"]).all()
    per = out.groupby("source_size")[["target"]].first()
    assert abs(per["target"].sum() - out["size"].sum()) < 1e-6
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.select("_key").distinct().count() == 2
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix_documents(docs).collect()))
    assert mixing.mix_documents(empty).count() == 0
    sizes = [("s" + k, i, s) for k, n, s in (("a", 100, 10), ("b", 1000, 10), ("c", 500, 21)) for i in range(n)]
    many = materialize(spark.createDataFrame(sizes, "_key string, _id long, _size long").withColumn("_tie", F.lit(0)), "sizes")
    report = mixing.mix_report(many).toPandas()
    targets = {1000.0: 3000.0}  # the first source stops at three times its size
    for size, group in report.groupby("source_size"):
        assert abs(group["taken"].sum() - group["target"].iloc[0]) <= 21
        if size in targets:
            assert group["target"].iloc[0] == targets[size]
    assert abs(report.groupby("source_size")["target"].first().sum() - 21500) < 1e-6


def test_ranges(spark):
    ids = [*range(5000), 2**62, None, -(2**63)]
    table = spark.createDataFrame([(i,) for i in ids], "i long")
    cuts = range_cuts(table, "i", 50)
    parts = {r["i"]: r["p"] for r in table.filter("i is not null").select("i", range_of(F.col("i"), cuts).alias("p")).collect()}
    assert parts == {i: bisect.bisect_right(cuts, i) for i in ids if i is not None}
    assert max(Counter(parts.values()).values()) < 3 * 5000 / 50 and len(set(parts.values())) == 50
    assert range_cuts(table.filter("i is null"), "i", 50) == [] and range_cuts(table.limit(0), "i", 50) == []


def test_lines(docs, unique, empty):
    out = {r.doc_id: r for r in linededup.line_report(unique).collect()}
    later = next(r for r in rows() if r[1] == "x\na\nb\nz\n\n")
    first = next(r for r in rows() if r[1] == "a\nb\nc\nd")
    late = max(later[0], first[0])
    assert out[late].n_removed == 2 and out[late].n_runs == 1
    kept = {later[0]: "x\nz\n\n", first[0]: "c\nd"}[late]
    assert out[late].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert linededup.line_report(docs).count() == len(rows())
    assert linededup.line_report(empty).count() == 0
    assert linededup.remove_lines(docs).columns == docs.columns


def test_long_lines(spark):
    long, short = [" ".join(words(k, n)) for k, n in ((21, 51), (22, 50))]
    texts = [long, f"u1\n{long}\nu2", f"u3\n{short}\nu4", f"u5\n{short}\nu6", long, f"p\nq\n{long}", f"v\np\nq\n{long}\n\nw", f"{long}\n{long}"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r["_row"].doc_id: r for r in linededup.drop_repeated_lines(table, long_words=50).collect()}
    gone = {i: r["_n_removed"] for i, r in out.items()}
    assert gone == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1, 5: 1, 6: 3, 7: 2} and all(out[i]["_n_runs"] == (gone[i] > 0) for i in out)
    left = {r.doc_id: r.text for r in linededup.remove_lines(table).collect()}
    assert left == {0: long, 1: "u1\nu2", 2: texts[2], 3: texts[3], 5: "p\nq", 6: "v\n\nw"}


def test_quality(spark, sf_dir, docs, empty):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.judge(documents, labels).join(labels, "doc_id").toPandas()
    good = (out.quality == 1) & (out.toxic == 0)
    assert out.loc[good, "kept"].mean() > 0.98
    assert quality.judge(docs, labels.limit(0)).filter("not kept").count() == 0
    assert quality.judge(docs, labels).count() == len(rows())
    assert quality.keep_good(empty, labels).count() == 0


def test_quality_held_out():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "dog", "tree", "runs"]) for _ in range(40)) for _ in range(400)]
    labels = np.zeros((400, 2), dtype=int)
    for i in range(0, 400, 4):
        texts[i] = texts[i].upper() if i % 8 else texts[i] + " moron"
        labels[i] = (1, 0) if i % 8 else (0, 1)
    ids, shapes = quality.features(texts)
    model = quality.fit(ids[:300], shapes[:300], labels[:300])
    assert ((model.logits(ids[300:], shapes[300:]) > 0) == (labels[300:] == 1)).mean() > 0.97


def test_licenses(docs, empty):
    out = licenses.scan_licenses(docs).toPandas()
    assert len(out) == len(rows())
    assert out["n_licensed"].sum() == 1 and out.loc[out.n_licensed == 1, "families"].iloc[0] == ["mit"]
    assert licenses.scan_licenses(empty).count() == 0


def test_license_notices(spark):
    def wrap(t, n=7):
        w = t.split()
        return "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))

    long = {f: max(licenses.TEMPLATES[f], key=len) for f in ("apache-2.0", "bsd-3-clause", "gpl-3.0", "mit")}
    body = [" ".join(words(k, 60)) for k in range(60)]
    texts = ["All rights reserved.", *(f"{body[0]}\n\n{wrap(t)}\n{body[1]}" for t in long.values()), f"{wrap(long['mit'])}\n\n{wrap(long['mit'])}"]
    # Half of the notice in each of two blocks is no notice.
    texts += ["\n\n".join(wrap(long["mit"]).split("\n")[:1] + [" ".join(body[2].split()[:9])]), *body]
    out = {r.doc_id: (r.n_licensed, r.families) for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [out[i] for i in range(6)] == [(1, ["proprietary"]), *((1, [f]) for f in long), (2, ["mit"])]
    assert all(out[i] == (0, []) for i in range(6, len(texts)))


def test_license_sample(spark):
    texts = ["head " + "x" * 900 + f"\nbody{i} words\n\n-- 12\ntail{i} " + "y " * 600 + f"end{i}" for i in range(30)]
    table = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    lines = {x for t in texts for x in t.split("\n") if re.search("[a-z]", x)}
    assert set(licenses.sample_lines(table, 1000)) == lines
    few = licenses.sample_lines(table, 20)
    assert len(few) <= 20 and set(few) <= lines and any(x[:4] in ("body", "tail") for x in few) and few == licenses.sample_lines(table.repartition(5), 20)


def test_chroma(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=64) * 0.3
    moved = np.concatenate([rng.normal(size=10) * 0.3, base[:54]])
    vectors = [(0, base.tolist()), (1, base.tolist()), (2, moved.tolist()), (3, (rng.normal(size=64) * 0.3).tolist()), (4, None), (5, [])]
    out = {r.rec_id: r for r in chroma.recording_report(spark.createDataFrame(vectors, "rec_id long, vector array<double>")).collect()}
    assert out[0].class_id == out[1].class_id == 0 and out[0].n_links == 2  # its copy, and the shifted recording
    assert out[4].n_codes == out[5].n_codes == 0 and out[3].n_links is None


def test_chroma_recall(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(900, 64)) * 0.1
    for k in range(30):  # of each queried one a noisy copy, one moved by some notes, and an excerpt between other notes
        own = vectors[30 * k]
        vectors[30 * k + 1] = own + rng.normal(size=64) * 0.008
        vectors[30 * k + 2] = np.concatenate([own[4 + k % 20 :], vectors[30 * k + 2][: 4 + k % 20]]) + rng.normal(size=64) * 0.004
        vectors[30 * k + 3][16:48] = own[8:40]
    ids = [50 * i // 30 if i % 30 == 0 else 50 * i + 1 for i in range(900)]
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)] + [(7, None), (9, []), (11, [0.1] * 10), (50, vectors[30].tolist()), (None, vectors[60].tolist())]
    table = materialize(spark.createDataFrame(rows, "rec_id long, vector array<double>"), "recordings")
    prints = materialize(chroma.fingerprint_rows(table.filter("rec_id is not null")).selectExpr("rec_id", "rec_id as class_id", "codes").dropDuplicates(["class_id"]), "recall")
    codes = {r.rec_id: np.array(r.codes, dtype=np.uint32) for r in prints.collect()}
    stack = {i: c for i, c in codes.items() if len(c) >= chroma.LEAST_POSITIONS}
    want = {}
    for q in (i for i in stack if i % 50 == 0):
        for c, b in stack.items():
            a = stack[q]
            for s in range(chroma.LEAST_POSITIONS - len(b), len(a) - chroma.LEAST_POSITIONS + 1) if c != q else ():
                i = max(0, s)
                n = min(len(a) - i, len(b) - (i - s))
                if np.bitwise_count(a[i : i + n] ^ b[i - s : i - s + n]).sum() <= chroma.BIT_ERRORS * 32 * n:
                    want.setdefault((q, c), set()).add(s)
    got = {(r.q, r.c): r["shift"] for r in chroma.alike(prints).collect()}
    assert len(want) > 60 and all(s in want.get(k, ()) for k, s in got.items())
    print("recall against brute force:", len(got) / len(want))
    assert len(got) >= 0.9 * len(want)
    report = {}
    for r in chroma.recording_report(table).collect():
        report.setdefault(r.rec_id, []).append(r)
    assert sum(map(len, report.values())) == len(rows) and len(report[50]) == 2 and report[None][0].n_links is None
    assert report[7][0].n_codes == report[9][0].n_codes == 0 and report[50][0].n_links >= 1


def test_chroma_repeated_passages(spark):
    rng = np.random.default_rng(5)
    x, y, z = (rng.integers(0, 2**32, size=n).tolist() for n in (40, 20, 30))
    codes = {0: x + y, 1: x + z + x + y, 2: z + z, 3: x[:1] + z[:20] + x[:1]}
    prints = spark.createDataFrame([(k, k, v) for k, v in codes.items()], "rec_id long, class_id long, codes array<long>")
    got = [(r.q, r.c, r["shift"], r.bit_errors, r.covered) for r in chroma.alike(prints).collect()]
    assert got == [(0, 1, 0 - len(x + z), 0.0, 60)]
    empty = prints.filter("rec_id < 0")
    assert chroma.alike(empty).count() == 0 and chroma.recording_report(empty.selectExpr("rec_id", "cast(codes as array<double>) as vector", "class_id as codes", "1 as q")).count() == 0


def test_revisits(spark):
    t = "timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m)"
    captures = spark.sql(f"""select record_id, url, {t} captured_at, kind, etag, cast(null as string) last_modified, map('etag', coalesce(etag, ''), h, 'v' || record_id) headers from values
      (1L, 'http://www.A.b/x/', 0, 'response', 'e1', 'content-type'), (2L, 'https://a.b/x?utm_source=q', 5, 'response', 'e2', 'content-type'),
      (3L, 'http://a.b/x#f', 3, 'revisit', 'e1', 'expires'), (4L, 'http://a.b/x', 9, 'revisit', 'W/e2', 'set-cookie'), (5L, 'http://a.b/x', 9, 'revisit', 'e1', 'expires'),
      (6L, 'http://a.b/y', 9, 'revisit', null, 'expires'), (7L, 'http://a.b/x', 0, 'revisit', 'e1', 'expires'), (8L, null, 9, 'revisit', 'e1', 'expires') v(record_id, url, m, kind, etag, h)""")
    out = {r.record_id: r for r in revisits.resolve_revisits(captures).collect()}
    assert {k: (r.status, r.response_id) for k, r in out.items()} == {3: ("resolved", 1), 4: ("resolved", 2), 5: ("validator mismatch", None), 6: ("no earlier response", None), 7: ("no earlier response", None), 8: ("no earlier response", None)}
    assert out[3].headers == {"content-type": "v1", "etag": "e1", "expires": "v3"} and "set-cookie" not in out[4].headers


def test_revisit_rules(spark):
    url = revisits.canonical_url
    got = spark.sql("select * from values ('HTTP://u@WWW.A.b:80/Page/?B=2&a=1&UTM_x=3#f'), ('http://a.b/page?a=1&B=2'), (null) t(u)").select(url("u").alias("k")).collect()
    assert [r.k for r in got] == ["a.b/Page?B=2&a=1", "a.b/page?B=2&a=1", None]
    t = "timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m)"
    captures = spark.sql(f"""select record_id, url, {t} captured_at, kind, etag, cast(null as string) last_modified, h headers, 'x' part, 1 micros, 'y' answer, 2 hit from values
      (1L, 'http://a.b/Page', 0, 'response', 'e1', map('Content-Type', 'upper', 'X', null)), (2L, 'http://a.b/page', 1, 'response', 'e1', map('Content-Type', 'lower', 'Cache-Control', 'a', 'cache-control', 'b')),
      (3L, 'http://a.b/Page', 5, 'revisit', 'e1', map('Cache-Control', 'max-age=9', 'Set-Cookie', 'q')), (3L, 'http://a.b/page', 5, 'revisit', 'e1', null),
      (null, 'http://a.b/page', 6, 'revisit', null, map('EXPIRES', 'z')), (null, 'http://c.d/', 1, 'response', 'n', map('a', 'b')), (9L, 'http://c.d', 2, 'revisit', 'n', map('date', 'd')),
      (10L, 'http://e.f', 3, 'response', 'x', map('a', '1')), (10L, 'http://e.f', 3, 'response', 'y', map('a', '2')), (11L, 'http://e.f', 4, 'revisit', 'y', map('vary', 'v')), (12L, 'http://e.f', null, 'revisit', 'y', null)
      v(record_id, url, m, kind, etag, h)""")
    out = sorted(((r.record_id or 0), r.url_key, r.status, r.response_id, r.headers) for r in revisits.resolve_revisits(captures).collect())
    assert out == [
        (0, "a.b/page", "resolved", 2, {"content-type": "lower", "cache-control": "b", "expires": "z"}),
        (3, "a.b/Page", "resolved", 1, {"content-type": "upper", "cache-control": "max-age=9"}),
        (3, "a.b/page", "resolved", 2, {"content-type": "lower", "cache-control": "b"}),
        (9, "c.d", "resolved", None, {"a": "b", "date": "d"}),
        (11, "e.f", "resolved", 10, {"a": "2", "vary": "v"}),
        (12, "e.f", "no earlier response", None, None),
    ]
    assert revisits.resolve_revisits(captures.limit(0)).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "test-" + name.replace(" ", "-"))
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
