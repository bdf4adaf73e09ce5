"""Operators and pipeline stages that SQL can't express, against plain recomputation in Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cogwright.llm import hyperminhash, licenses, linededup, mixing, packing, quality, simhash, suffixdedup
from cogwright.llm.common import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows, schema="doc_id long, text string"):
    return materialize(spark.createDataFrame(rows, schema), "brute")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def optimum(sizes, capacity):
    """Least number of sequences, by trying all; sizes are few."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            if b + sizes[i] <= capacity:
                rest = list(bins)
                rest[rest.index(b)] += sizes[i]
                place(i + 1, rest)
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_packing_optimum():
    rng = random.Random(2)
    ours = best = 0
    for _ in range(60):
        sizes = sorted((rng.randrange(3, 30) for _ in range(9)), reverse=True)
        runs, fixed = packing.plan_packing(dict(Counter(sizes)), 32)
        n, least = sum(r.times for r in runs), optimum(sizes, 32)
        assert least <= n <= least + 1 and (fixed < n or n == least)
        ours, best = ours + n, best + least
    assert ours <= 1.02 * best


def test_pieces(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    long = " ".join(f"word{i} and é{i % 7}" for i in range(900))
    texts = [(1, long), (2, "short"), (3, None), (4, ""), (None, "no id"), (2, "short"), (5, long + "x" * 3_000_000)]
    got = packing.pack_documents(table(spark, texts)).toPandas()
    for doc_id, text in ((1, long), (2, "short"), (3, ""), (4, "")):
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        mine = got[got.doc_id == doc_id].sort_values(["piece", "sequence_id"])
        mine = mine.drop_duplicates("piece")
        assert mine["piece"].tolist() == list(range(len(mine))) and mine["length"].sum() == len(ids)
        assert mine["start"].tolist() == [0, *np.cumsum(mine["length"])[:-1]]
        assert len(mine) == max(1, math.ceil(len(ids) / 1024)) and (mine["length"].iloc[1:] == 1024).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine["start"], mine["length"], strict=True)] == mine["ids_crc32"].tolist()
    assert (got.doc_id == 2).sum() == 2 and got.doc_id.isna().sum() == 1 and (got.doc_id == 5).sum() > 100


def fingerprint(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
    pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    terms = Counter([pair(a, b) for a, b in zip(h, h[1:])] if len(h) > 1 else h)
    votes, total = [0] * 128, 0
    for t, n in terms.items():
        w = int(4 * (1 + math.log2(n)))
        total += w
        for k, x in enumerate((t, xxhash.xxh64_intdigest(t.to_bytes(8, "little"), 42))):
            for i in range(64):
                votes[64 * (1 - k) + i] += w * (x >> i & 1)
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > total)


def test_simhash_bits(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").limit(40).collect()]
    rows += [(10**15, "far id, one two one two one two"), (-5, "lone"), (2**60, None)]
    rows.sort()
    out = {r.doc_id: r for r in simhash.near_report(table(spark, rows)).collect()}
    texts = [t or "" for _, t in rows]
    prints = [fingerprint(t) for t in texts]
    for i, (doc_id, _) in enumerate(rows):
        k = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - k] + texts[(i + 1) % len(texts)][:k]
        r, e = out[doc_id], fingerprint(edited)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(texts[i])
        assert (r.fingerprint, r.edited_fingerprint) == (f"{prints[i]:032x}", f"{e:032x}")
        assert r.near_edited == 1 - (prints[i] ^ e).bit_count() / 128
        assert r.near_next == 1 - (prints[i] ^ prints[(i + 1) % len(prints)]).bit_count() / 128


def strings(texts, n):
    """Spans, removed bytes and kept bytes of every text (in order) by the set of all strings before it."""
    seen, out = set(), []
    for t in texts:
        b = t.encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - n + 1):
            if b[p : p + n] in seen:
                gone[p : p + n] = True
            seen.add(b[p : p + n])
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_spans(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").limit(60).collect()]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(10**9 + i, f"{'u' * (i % 5)}{i} {passage} {i * 7919}") for i in range(40)] + [(2**61, None), (-3, "")]
    rows.sort(key=lambda r: r[0])
    want = dict(zip([r[0] for r in rows], strings([t or "" for _, t in rows], 100), strict=True))
    docs = table(spark, [(*r, "clash", 1) for r in rows], "doc_id long, text string, anchor string, size int")
    for shard in (4_000_000, 2_000):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.remove_repeats(docs, 100, shard).collect()}
        assert got == want


def test_repeats_long_text(spark):
    rng = random.Random(4)
    block = "".join(rng.choice("abcdefgh ") for _ in range(2_100_000))
    out = {r.doc_id: r.n_removed for r in suffixdedup.remove_repeats(table(spark, [(1, block), (2, "x" + block[1_000_000:2_050_000] + "y")]), 100).collect()}
    assert out == {1: 0, 2: 1_050_000}


def run_lines(rows, run, long_words):
    """Documents (in order) without lines of later windows."""
    out, seen, lines = {}, set(), {}
    for key, text in rows:
        own = text.split("\n")
        worded = [i for i, x in enumerate(own) if WORD.search(x)]
        lines[key] = own, worded
        h, gone = [own[i] for i in worded], set()
        for k in range(len(h)):
            for n in {run, 1} if long_words is not None and len(WORD.findall(h[k])) > long_words else {run}:
                w = tuple(h[k : k + n])
                if len(w) == n:
                    if w in seen:
                        gone |= set(range(k, k + n))
                    seen.add(w)
        removed = {worded[k] for k in gone}
        out[key] = ("\n".join(x for i, x in enumerate(own) if i not in removed), len(worded), len(removed))
    return out


@pytest.mark.parametrize("run,long_words", [(2, None), (3, None), (2, 5), (4, 3)])
def test_lines_by_hand(spark, run, long_words):
    rng = random.Random(run)
    pool = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 9))) for _ in range(14)] + ["", "  \t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(80)] + [(10**12, pool[0] + "\n" + pool[1]), (-9, "one line")]
    rows.sort()
    want = run_lines(rows, run, long_words)
    got = {r["_row"].doc_id: (r["_kept"], r["_n_lines"], r["_n_removed"]) for r in linededup.drop_repeated_lines(table(spark, rows), run, long_words).collect()}
    assert got == want


def test_lines_come_through_winnowing(spark, monkeypatch):
    rows = [(i, f"a{i}\nsame\nlines\nz{i}") for i in range(4)]
    docs = table(spark, rows)
    prints = linededup.fingerprints(docs.selectExpr("doc_id as _id", "0L as _sub", "text"), 2)
    # Every window has its minimum among the fingerprints, and lines that are no window's minimum are none.
    found = {(r["_id"], w.k): r["at"] for r in prints.collect() for w in r["wins"]}
    assert set(found) == {(i, k) for i in range(4) for k in range(3)} and all(k <= at <= k + 1 for (_, k), at in found.items())
    hashes = {i: [xxhash.xxh64_intdigest(x.encode(), 42) for x in t.split("\n")] for i, t in rows}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    assert all(signed(hashes[i][at]) == min(map(signed, hashes[i][k : k + 2])) for (i, k), at in found.items())
    monkeypatch.setattr(linededup, "fingerprints", lambda d, *a: prints.filter("_id < 0"))
    assert linededup.repeated_runs(docs.selectExpr("doc_id as _id", "0L as _sub", "text")).count() == 0


def shingles(t, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in sets:
        for x in s:
            by[x].append((i, s))
    for group in by.values():
        for i, s in group:
            for j, t in group:
                if i < j and root(i) != root(j) and 100 * len(s & t) >= percent * len(s | t):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: root(i) for i, _ in sets}


def test_near_rows_of_tables(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(documents, 3, 85).collect()}
    assert got == components(rows, 3, 85)


def test_near_groups_close_to_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 30)  # buckets are several blocks
    rng = random.Random(12)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(220):  # copies with a few words changed: some pairs link, most don't
        own = base[:]
        for k in rng.sample(range(100), rng.choice((2, 3, 4, 5))):
            own[k] = f"n{i}x{k}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(table(spark, rows), 3, 85).collect()}
    assert got == components(rows, 3, 85)


def test_quality_rates(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.judge(documents, labels).toPandas()
    given = labels.toPandas()
    reject = {d: float(q == 0 or t == 1) for d, q, t in zip(given.doc_id, given.quality, given.toxic, strict=True)}
    p = np.array([reject.get(d, np.nan if np.isnan(s) else 1 / (1 + math.exp(-s))) for d, s in zip(out.doc_id, out.doc_score.astype(float), strict=True)])
    rate = (np.nansum(p) + 0.5) / (np.sum(~np.isnan(p)) + 1)

    def strength(groups, centres):
        n = np.array([np.sum(~np.isnan(p[g])) for g in groups], dtype=float)
        s = np.array([np.nansum(p[g]) for g in groups])
        c, use = np.array(centres), n > 0
        n, s, c = n[use], s[use], c[use]
        within = (n * c * (1 - c)).sum() / n.sum()
        room = n.sum() - (n * n).sum() / n.sum()
        between = max(0.0, (n * (s / n - c) ** 2).sum() - (len(n) - 1) * within) / room if room > 0 else 0.0
        return min(1e6, max(1.0, within / between - 1)) if between > 0 else 1e6

    hosts = {h: g.index.to_numpy() for h, g in out.groupby("host")}
    k = strength(hosts.values(), [rate] * len(hosts))
    host_rate = {h: (k * rate + np.nansum(p[g])) / (k + np.sum(~np.isnan(p[g]))) for h, g in hosts.items()}
    paths = {x: g.index.to_numpy() for x, g in out.groupby(["host", "path"])}
    k = strength(paths.values(), [host_rate[h] for h, _ in paths])
    path_rate = {x: (k * host_rate[x[0]] + np.nansum(p[g])) / (k + np.sum(~np.isnan(p[g]))) for x, g in paths.items()}
    for _, r in out.iterrows():
        assert r.host_rate == pytest.approx(host_rate[r.host]) and r.path_rate == pytest.approx(path_rate[(r.host, r.path)])
        told = min(max(reject[r.doc_id], 0.01), 0.99) if r.doc_id in reject else None
        base = math.log(told / (1 - told)) if told is not None else math.log(rate / (1 - rate)) if np.isnan(r.doc_score) else r.doc_score
        odds = math.log(r.path_rate / (1 - r.path_rate)) - math.log(rate / (1 - rate))
        assert r.reject_probability == pytest.approx(1 / (1 + math.exp(-(base + odds)))) and r.kept == (r.reject_probability < 0.5)


def test_quality_nulls(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "cast(quality as int) quality", "cast(toxic as int) toxic", "'x' host")
    schema = "doc_id long, text string, source string, lang string, host string, path string, logit double, label int"
    rows = [(None, "a b c", None, "en", "h", "p", 1.0, 1), (None, "d e f", "", "en", "h", "p", 1.0, 1), (1, None, "s", None, "h", "p", 1.0, 1), (1, "", "s", "", "h", "p", 1.0, 1), (2, "same words", "s", "en", "h", "p", 1.0, 1), (2, "same words", "s", "en", "h", "p", 1.0, 1)]
    extra = spark.createDataFrame([(None, 0, 1, "x"), (None, 0, 1, "x"), (2, None, 1, "x")], "doc_id long, quality int, toxic int, host string")
    docs = table(spark, rows + [(r.doc_id, r.text, r.source, r.lang, "h", "p", 0.0, 0) for r in documents.collect()], schema)
    both = labels.union(extra)
    a, b = quality.train(docs, both), quality.train(docs, labels)
    assert (a.used == b.used).all() and np.allclose(a.hashed, b.hashed) and np.allclose(a.shaped, b.shaped)
    out = quality.judge(docs, both)
    assert out.count() == docs.count()
    odd = [(r.host, r.path) for r in out.filter("doc_id is null").orderBy("path").collect()]
    assert odd == [("", "/en"), (None, "?/en")] and {r.path for r in out.filter("doc_id = 1 and host = 's'").collect()} >= {"s?", "s/"}
    assert quality.judge(docs, labels.limit(0)).filter("kept").count() == docs.count()
    assert quality.keep_good(docs, both).columns == docs.columns
    host, path = quality.url_site("u")
    sites = spark.sql("select * from values ('HTTPS://u@Ex.org:8/a/b?q'), ('//x.y'), ('z') t(u)").select(host.alias("h"), path.alias("p")).collect()
    assert [tuple(r) for r in sites] == [("ex.org", "ex.org/a"), ("x.y", "x.y"), ("", "")]


def test_quality_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.filter("pmod(xxhash64(doc_id), 2) = 0"))
    scored = quality.score(docs.select("doc_id", "text"), model, ["doc_id"]).join(labels.filter("pmod(xxhash64(doc_id), 2) = 1"), "doc_id").toPandas()
    bad = (scored.quality == 0) | (scored.toxic == 1)
    right = ((scored.logit > 0) == bad).mean()
    print("held-out accuracy of the document classifier:", right)
    assert right > 0.95


def test_licenses_held_out(documents):
    lines = sorted({x for r in documents.select("text").collect() for x in (r.text or "").split("\n") if len(WORD.findall(x)) > 3})
    known = [t.lower() for ts in licenses.TEMPLATES.values() for t in ts]
    lines = [x for x in lines if not any(t in x.lower() for t in known)]
    random.Random(1).shuffle(lines)
    weights, temperature = licenses.fit(lines[: len(lines) // 2])
    texts, labels = licenses.training_rows(lines[len(lines) // 2 :], seed=77)
    texts = [t.replace("\n", " ") for t in texts]
    p = licenses._softmax(licenses._scores(texts, weights) / temperature)
    guess = np.where(p.max(axis=1) >= licenses.THRESHOLD, p.argmax(axis=1), licenses.UNKNOWN)
    family, other = labels != licenses.UNKNOWN, labels == licenses.UNKNOWN
    right, kept = (guess == labels)[family].mean(), (guess == labels)[other].mean()
    loss = -np.log(np.maximum(1e-12, p[np.arange(len(labels)), labels])).mean()
    print("held-out families, unknown lines, log loss:", right, kept, loss)
    assert right > 0.9 and kept > 0.99 and loss < 0.25


def test_license_odd_rows(spark):
    long = "word " * 300_000 + "\nReleased under the MIT License.\n" + "other " * 300_000
    rows = [(1, long, "x", 1), (1, long, "x", 1), (None, "Licensed under CC BY 4.0.", None, 2), (3, None, "y", 3), (4, "", "y", 3)]
    out = licenses.scan_licenses(table(spark, rows, "doc_id long, text string, h string, sub int")).collect()
    assert sorted((r.doc_id or 0, r.n_licensed, tuple(r.families)) for r in out) == [(0, 1, ("cc-by",)), (1, 1, ("mit",)), (1, 1, ("mit",)), (3, 0, ()), (4, 0, ())]


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        columns = docs.columns
        docs = materialize(stage(spark, docs, sf_dir), "brute-" + name.replace(" ", "-"))
        rows = [r.asDict() for r in docs.collect()]
        by_id = Counter(r["doc_id"] for r in rows)
        if name != "packing":
            assert docs.columns == columns
        texts = sorted((r["doc_id"], r["text"] or "") for r in before)
        if name == "quality classifier":
            judged = quality.judge(spark.createDataFrame([(r["doc_id"], r["text"], r["source"], r["lang"]) for r in before], "doc_id long, text string, source string, lang string"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert by_id == Counter(r.doc_id for r in judged.filter("kept").collect())
        elif name == "line dedup":
            want = {k: t for k, (t, n, gone) in run_lines(texts, 2, 50).items() if gone == 0 or gone < n}
            assert {r["doc_id"]: r["text"] for r in rows} == want and all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "near dedup":
            assert set(by_id) == {i for i, c in components(texts, 5, 80).items() if i == c} and max(by_id.values()) == 1
        elif name == "mixing":
            size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in before}
            per = defaultdict(int)
            for r in before:
                per[r["source"]] += size[r["doc_id"]]
            sources = sorted(per, key=lambda s: (s is None, s or ""))
            weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sources)}
            level, full = 0.0, set()
            while True:  # water filling
                left = sum(per.values()) - sum(3 * per[s] for s in full)
                level = left / sum(weight[s] for s in sources if s not in full) if len(full) < len(sources) else 0.0
                more = {s for s in sources if s not in full and level * weight[s] > 3 * per[s]}
                if not more:
                    break
                full |= more
            longest = max(size.values())
            taken = defaultdict(int)
            for r in rows:
                taken[r["source"]] += size[r["doc_id"]]
            assert max(by_id.values()) <= 3
            for s in sources:
                target = 3 * per[s] if s in full else level * weight[s]
                assert abs(taken[s] - target) <= longest
        else:
            of = defaultdict(list)
            for r in rows:
                of[r["sequence_id"]].append((r["offset"], r["length"]))
            for pieces in of.values():
                pieces.sort()
                assert [a for a, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]] and sum(n for _, n in pieces) <= 1024
            ids = packing.encode([r["text"] or "" for r in before], "byte_bpe_50k.json")
            assert sum(r["length"] for r in rows) == sum(len(x) + 1 for x in ids)
    assert mixing.CAP == 3
