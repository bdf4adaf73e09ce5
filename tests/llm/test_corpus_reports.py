"""Divergence of sources, token files and the conversation trie, against SQL and plain recomputation."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cogwright.llm import convtrie, divergence, tokenfiles
from cogwright.llm.common import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string"
TURNS = "conv_id long, turn long, role string, text string"


def table(spark, rows, schema):
    return materialize(spark.createDataFrame(rows, schema), "reports")


def ordered(rows):
    return sorted(map(repr, rows))


def sql(text, view, file):
    c = duckdb.connect()
    c.execute(f"create view {view} as select * from '{file}'")
    return c.execute(text).fetchall()


def divergence_rows(rows):
    """The report over (doc_id, text, lang, source), recomputed with whole tables of shares."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= 3)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= 3) for s in {d[1] for d in mine}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in counts.items()}
        whole = share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= 200]
    return out


def test_divergence(spark):
    rng = random.Random(5)
    words = [*"abcdefghij", "Äb", "äb", "É", "naïve", "x1y", "don't", "λόγος", "😀"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), rng.choice(["en", "de", None, "", "z z"]), rng.choice(["s1", "s2", "ß", None])) for i in range(120)]
    rows += [(None, None, None, "quiet"), (7, "", "xx", "alone"), (7, "rare rare", "xx", "other"), *[(8, "A-b, C" * 3000, "long", s) for s in ("s", "s", "t", "t")]]
    assert ordered(map(tuple, divergence.divergence_report(table(spark, rows, DOCS)).collect())) == ordered(divergence_rows(rows))


def test_divergence_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 50)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("abcdefghijklmnop", k=9)), "en", rng.choice("stuv")) for i in range(60)]
    assert ordered(map(tuple, divergence.divergence_report(table(spark, rows, DOCS)).collect())) == ordered(divergence_rows(rows))


def test_divergence_empty(spark):
    assert divergence.divergence_report(table(spark, [], DOCS)).collect() == []
    few = divergence.divergence_report(table(spark, [(1, None, "en", "s"), (2, "12", "en", "t"), (3, "ab", "en", "t")], DOCS)).collect()
    assert ordered(map(tuple, few)) == ordered([("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)])


def test_divergence_sql(spark, sf_dir):
    got = divergence.divergence_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert ordered(map(tuple, got)) == ordered(sql(divergence.REPORT_SQL, "documents", f"{sf_dir}/documents.parquet"))


def test_exact_share(spark):
    from pyspark.sql import functions as F

    n, total, size = 4 * 10**15 + 7, 9 * 10**15 + 11, 10**7
    got = spark.range(1).select(divergence._share(F.lit(n), F.lit(total), F.lit(size)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (total + size)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000, 600_000])
def test_segment(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50_257, n).astype(np.uint32)
    ids[rng.random(n) < 0.03] = 2**32 - 1
    if n > 300:
        ids[128:256] = 77  # a block of width 0
    raw = tokenfiles.encode_segment(np.array([3, 9]), np.array([n // 3, n - n // 3]), ids)
    segment = tokenfiles.Segment(memoryview(raw))
    assert segment.size == len(raw) and list(segment.doc_ids) == [3, 9] and segment.lengths.sum() == n
    for a, b in ((0, n), (n // 3, n // 2), (max(n - 1, 0), n), (n // 2, n // 2)):
        assert (segment.ids(a, b) == ids[a:b]).all()


def test_segment_small():
    """Frames of reference take less room than plain 32-bit ids, outliers or not."""
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1000, 100_000).astype(np.uint32)
    ids[::50] = 49_999
    assert len(tokenfiles.encode_segment(np.array([1]), np.array([len(ids)]), ids)) < 0.5 * ids.nbytes


def token_rows(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_token_files(spark, sf_dir, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    spaces = "a  b   c \n d\te f　 g don 't <|endoftext|> x<|endoftext|>\x1c y \x85 z   q  "
    rows += [(None, None), (None, "q"), (-4, ""), (3, spaces), (3, spaces), (2**40, "x" * 300_000 + " y" * 400_000), (2**41, "word " * 90_000)]
    got = tokenfiles.token_report(table(spark, rows, "doc_id long, text string")).collect()
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered(token_rows(rows))
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 50)
    small = tokenfiles.WordEncoder("byte_bpe_50k.json")
    for _ in range(2):
        ids, counts = small.encode_all([t or "" for _, t in rows[:40]])
        assert (counts + 1).tolist() == [n for _, n, _ in token_rows(rows[:40])] and len(ids) == counts.sum()


def test_words_as_the_whole_text():
    """Pieces that are encoded by themselves give the ids of the whole text, whatever stands next to each other."""
    rng, known = random.Random(1), tokenfiles.WordEncoder("byte_bpe_50k.json")
    alphabet = [*"abcXYZ", *"äÉßÿ", "ª", "µ", "λ", "ж", "中", "'", "'s", "'ll", "n't", " ", " ", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", "　", "3", "٣", "²", ".", ",", "!", "_", "-", "́", "😀", "×", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choices(alphabet[: -2 if i % 3 else None], k=rng.randrange(0, 14))) for i in range(6000)]
    ids, counts = known.encode_all(texts)
    whole = known._tokenizer.encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in whole] and ids.tolist() == [i for e in whole for i in e.ids]


def test_token_files_clash_and_empty(spark):
    extra = "doc_id long, text string, _id string, _tie long, segment binary, content string"
    got = tokenfiles.token_report(table(spark, [(2, "b", "x", 1, b"\n", "c"), (1, "a", None, None, None, None)], extra)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(1, 0, 2), (2, 2, 2)]
    assert tokenfiles.token_report(table(spark, [], "doc_id long, text string")).collect() == []


def trie_rows(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        own[c].append((t is not None, t or 0, role or "", text or ""))
    seqs = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    made = {}
    for c, s in seqs.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 4
        made[c] = tuple((seqs.get(c - c + c // 20 * 20, [])[:h] if c is not None else []) + s[h:])
    nodes = defaultdict(list)
    for c, s in made.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    least = lambda m: None if None in m else min(m)
    saved, leaves = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
    out = []
    for p, m in nodes.items():
        ends = sorted((c for c in m if made[c] == p), key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((least(m), len(p), least(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], digest))
    return out


def trie_cases():
    rng = random.Random(3)
    few = [(c, t, rng.choice(["u", "a", None]), rng.choice(["x y", "z", None, ""])) for c in range(90) for t in range(rng.randrange(1, 7))]
    # Deep sharing over chunks, with copies, a fork and a conversation that is another's beginning.
    deep = [(c, t, "u", f"w{t} " * (t % 4)) for c in (5, 6, 7, 8, 25, 45, 65) for t in range({5: 140, 25: 150, 45: 150, 65: 90}.get(c, 131))] + [(45, 150, "u", "end"), (25, 149, "x", "fork")]
    copies = [(c, t, "u", f"hello {t}") for c in (*range(0, 3000, 3), 10**6, 10**12) for t in range(3)]
    odd = [(None, 2, "a", "b"), (None, None, "a", "first"), (21, 0, "a", "b"), (40, 1, "c", "d d"), (45, None, None, None), (45, 3, "q", "")]
    return {"few": few, "deep": deep, "copies": copies, "odd": odd, "turnless": [(21, 0, "a", "b"), (23, 0, "a", "b")]}


@pytest.mark.parametrize("case", sorted(trie_cases()))
def test_trie(spark, case):
    rows = trie_cases()[case]
    got = convtrie.conversation_trie(table(spark, rows, TURNS)).collect()
    assert ordered(map(tuple, got)) == ordered(trie_rows(rows))


def test_trie_empty_repeats_clash(spark):
    assert convtrie.conversation_trie(table(spark, [], TURNS)).collect() == []
    rows = [(c, t, "u", "same") for c in (20, 21, 22) for t in (0, 0, 1)]
    got = convtrie.conversation_trie(table(spark, [(*r, 1, "x") for r in rows], TURNS + ", conv long, pos string")).collect()
    assert ordered(map(tuple, got)) == ordered(trie_rows(rows))


def test_trie_sql(spark, sf_dir):
    file = f"{sf_dir}/conversations.parquet"
    assert ordered(map(tuple, convtrie.conversation_trie(spark.read.parquet(file)).collect())) == ordered(sql(convtrie.REPORT_SQL, "conversations", file))
