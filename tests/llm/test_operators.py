"""Each operator against a brute-force version, on hand-made and on the smallest driver tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from foliospark.llm import bpe, exact_dedup, jaccard_join, licenses, line_dedup, packing, quality_rules, sharding, substring_dedup, warc  # noqa: E402
from foliospark.llm.common import Staged  # noqa: E402
from foliospark.llm.components import components  # noqa: E402
from foliospark.llm.license_texts import KNOWN  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "  ", "a", "a  b\n c\t", "<|endoftext|> x<|endoftext|>", "I'll go. ΣΑΣ İ é ́", "\x1c a\x85b　 c", "日本語" * 300, "🙂👍🏽 1234", "x" * 3000, "the same text", "the same\ntext", "the same text"]


def odd_documents(spark):
    """Rows with nulls everywhere, repeats, and columns whose names clash with those used inside."""
    rows = [(i, t, "norm", 1, "w") for i, t in enumerate(ODD)] + [(None, "nobody", None, None, None), (None, None, None, None, None), (11, "the same text", "norm", 1, "w")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, digest string, uid int, w string")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids_of(path, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)], t


def near(texts, seed=3, n=40):
    """Texts that differ in a few words from a base, chains of them, and unrelated ones."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10_000)}"
        if rng.random() < 0.2:
            base = w
        out.append(" ".join(w))
    return out + texts


def classes(texts, n, num, den):
    """Brute force over all pairs."""
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for t in texts:
        w = SPLIT.findall((t or "").translate(low))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


def removed(texts, k):
    words = [SPLIT.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for p in range(i, i + k)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library(path):
    import pyarrow as pa

    rng = random.Random(1)
    texts = [t or "" for t in ODD] + ["ab" * 5000, "".join(rng.choice("étaoin") for _ in range(4000)), "<|startoftext|>a<|endoftext|><|endoftext|>\x1cb c", "\x1c a<|endoftext|> "]
    texts += ["".join(rng.choice(" \n\tab'.sΣé日🙂1́\xa0<|>ôX,") for _ in range(rng.randrange(80))) for _ in range(800)]
    want, _ = ids_of(path, texts)
    ids, counts = bpe.Encoder(path).encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == want


def test_encoder_forgets_and_learns_again():
    import pyarrow as pa

    e = bpe.Encoder(WORD, limit=3)
    for text in ("one two three four five", "six one seven"):
        e.trim()
        assert e.encode(pa.array([text]))[0].tolist() == ids_of(WORD, [text])[0][0]


def test_bpe_digests(spark):
    for df in (odd_documents(spark), documents(spark), odd_documents(spark).limit(0)):
        rows = df.select("doc_id", "text").collect()
        want, lib = ids_of(BYTE, [r.text for r in rows])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expect = Counter((r.doc_id, len(i), sha(",".join(map(str, i))), sha(lib.decode(i, skip_special_tokens=False))) for r, i in zip(rows, want, strict=True))
        assert Counter(tuple(r) for r in bpe.encode_digests(df, BYTE).collect()) == expect
        back = bpe.decode_ids(bpe.encode_documents(df, BYTE), BYTE)
        assert Counter(tuple(r) for r in back.collect()) == Counter((r.doc_id, r.text or "") for r in rows)


def check_packing(rows, docs, window):
    """Each document's ids, cut into pieces, lie gapless in sequences."""
    want = Counter()
    for r, i in zip(docs, ids_of(WORD, [r.text for r in docs])[0], strict=True):
        want[r.doc_id, tuple([*i, 2])] += 1
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    total = Counter()
    for d, pieces in by_doc.items():
        if sum(v for (x, _), v in want.items() if x == d) == 1:
            whole = [i for _, ids, _ in sorted(pieces) for i in ids]
            assert {n for _, _, n in pieces} == {len(whole)}
            total[d, tuple(whole)] += 1
    assert all(want[k] == v for k, v in total.items())
    assert sum(r.length for r in rows) == sum(len(i) * v for (_, i), v in want.items())


@pytest.mark.parametrize("window,shard", [(4096, 16 << 20), (64, 4000)])
def test_packing(spark, window, shard):
    for df in (odd_documents(spark), documents(spark)):
        check_packing(packing.pack_documents(df, WORD, window=window, shard_bytes=shard).collect(), df.select("doc_id", "text").collect(), window)
    assert packing.pack_documents(documents(spark).limit(0), WORD).count() == 0


def lexicon_of(docs, most=1 << 18):
    df = Counter(w for d in docs for w in set(d))
    words, n = np.array([w for w in df if df[w] > 1], np.uint64), np.array([df[w] for w in df if df[w] > 1])
    return packing.Lexicon(len(docs), sum(map(len, docs)), words, n, most)


def index_of(docs, lexicon):
    words = np.concatenate(docs).astype(np.int64)
    return packing.Index(words, np.arange(words.max() + 1, dtype=np.uint64), np.array([len(d) for d in docs]), lexicon)


def test_packing_prefers_lexical_neighbours():
    docs = [[1, 2, 3, 4], [11, 12, 13, 14]] * 2
    index = index_of(docs, lexicon_of(docs))
    assert list(index.neighbours(0, np.array([True, False, False, False]))) == [2]
    pieces = packing.fill(np.array([8, 8, 8, 8]), index, 16)
    assert {p[3] for p in pieces if p[0] in (0, 2)} == {0}


def test_packing_ranks_a_shard_by_all_shared_words_with_statistics_of_the_corpus():
    rng = np.random.default_rng(4)
    corpus = [rng.integers(1, 300, rng.integers(1, 200)).tolist() for _ in range(200)]
    docs = corpus[:80]
    docs[0] = list(range(1, 300))
    count = [Counter(d) for d in docs]
    df = Counter(w for d in corpus for w in set(d))
    mean = sum(map(len, corpus)) / len(corpus)
    index = index_of(docs, lexicon_of(corpus))
    for d, asked in enumerate(count):
        score = {}
        for e, c in enumerate(count):
            if e != d and (both := [w for w in asked if w in c]):
                score[e] = sum(math.log1p((200 - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(docs[e]) / mean)) for w in both)
        used = np.zeros(80, bool)
        used[d] = True
        got = list(index.neighbours(d, used))
        assert sorted(got) == sorted(score)
        assert np.allclose([score[e] for e in got], sorted(score.values(), reverse=True))


def test_packing_counts_the_whole_corpus(spark):
    from xxhash import xxh64_intdigest

    rows = [r.text for r in documents(spark).collect()] + [None, "", " . ", "One, two. ONE two"]
    norm = [[w for x in SPLIT.findall(t or "") if (w := x.strip(packing._MARKS).encode().lower())] for t in rows]
    df = Counter(w for d in norm for w in set(d))
    spread = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed, got = packing.survey(spread, Staged(spark))
    assert (got.n, got.other) == (len(rows), 1) and got.mean == sum(len(SPLIT.findall(t or "")) for t in rows) / len(rows)
    assert dict(zip(got.words.tolist(), got.counts.tolist(), strict=True)) == {xxh64_intdigest(w): n for w, n in df.items() if n > 1}
    few = packing.survey(spread, Staged(spark), most=50)[1]
    assert sorted(few.counts.tolist()) == sorted(sorted(df.values())[-50:]) and few.other == min(few.counts)
    assert packing.survey(spread.limit(0), Staged(spark))[1].n == 0
    found = {r.doc_id: r for r in keyed.collect()}
    hashes = [{xxh64_intdigest(w) for w in d} for d in norm]
    assert len(found) == len(rows)
    for i, own in enumerate(hashes):
        keys = [k % 2**64 for k in (found[i].k0, found[i].k1)]
        assert set(keys) <= own if own else keys == [0, 0]
        assert all(found[j].k0 == found[i].k0 for j, other in enumerate(hashes) if other == own)


def test_packing_knows_the_counts_of_words_beyond_the_listed(spark):
    from xxhash import xxh64_intdigest

    df = documents(spark)
    rows = df.collect()
    norm = {r.doc_id: {w for x in SPLIT.findall(r.text or "") if (w := x.strip(packing._MARKS).encode().lower())} for r in rows}
    held = Counter(w for d in norm.values() for w in d)
    st = Staged(spark)
    docs = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed, lexicon = packing.survey(docs, st, most=40)
    counts, keyed = keyed._counts, keyed.withColumn("mark", F.xxhash64("text"))
    got = packing.rare_words(keyed, counts, ["doc_id", "mark"], lexicon, st).collect()
    told = {r.doc_id: {(x.g % 2**64, x.n) for x in r.rare} for r in got}
    want = {i: {(xxh64_intdigest(w), held[w]) for w in d if 1 < held[w] < lexicon.other} for i, d in norm.items()}
    assert lexicon.other > 2 and told == {i: w for i, w in want.items() if w}
    lexicon.told([(np.array([x.g for r in got for x in r.rare]), np.array([x.n for r in got for x in r.rare]))])
    words = [w for w in held if held[w] > 1]
    n = np.array([held[w] for w in words])
    assert np.allclose(lexicon.idf(np.array([xxh64_intdigest(w) for w in words], np.uint64)), np.log1p((lexicon.n - n + 0.5) / (n + 0.5)))
    packs = [sorted(map(tuple, packing.pack_documents(df, WORD, window=512, shard_bytes=shard, listed=most).collect())) for shard in (60_000, 6 << 20) for most in (40, 1 << 18)]
    assert packs[0] == packs[1] and packs[2] == packs[3]


def test_packing_lists_whole_classes_of_counts(spark):
    """Five words in three documents, three in two: listed are as many as asked for, the most frequent first."""
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g"), (3, "a b c d e h x")], "doc_id bigint, text string")
    for most, want in ((4, [3] * 4), (5, [3] * 5), (6, [2] + [3] * 5), (8, [2] * 3 + [3] * 5), (9, [2] * 3 + [3] * 5)):
        lexicon = packing.survey(docs, Staged(spark), most=most)[1]
        assert sorted(lexicon.counts.tolist()) == want and lexicon.other == (1 if most == 9 else want[0])


@pytest.mark.parametrize("common", ["none", "half", "rarest"])
def test_packing_tells_rare_words_by_tasks(spark, monkeypatch, common):
    """Whatever words a sample lists, each document's words get their own counts, from one reading of the texts and without a
    row for each word of a document."""
    from xxhash import xxh64_intdigest

    rows = documents(spark).collect()
    norm = {r.doc_id: {xxh64_intdigest(w) for x in SPLIT.findall(r.text or "") if (w := x.strip(packing._MARKS).encode().lower())} for r in rows}
    held = Counter(w for d in norm.values() for w in d)
    shared = sorted(w for w in held if held[w] > 1)
    chosen = {"none": [], "half": shared[::2], "rarest": [w for w in shared if held[w] == 2]}[common]
    monkeypatch.setattr(packing, "common_words", lambda docs, most: np.array(chosen, np.uint64))
    plans = {}

    class Watched(Staged):
        def write(self, df, tag):
            plans[tag] = df._jdf.queryExecution().executedPlan().toString()
            return super().write(df, tag)

    st = Watched(spark)
    docs = spark.createDataFrame([(r.doc_id, r.text or "") for r in rows], "doc_id bigint, text string").repartition(5)
    keyed, lexicon = packing.survey(docs, st, most=40)
    got = {r.doc_id: r.rare for r in packing.rare_words(keyed, keyed._counts, ["doc_id", "place"], lexicon, st).collect()}
    assert lexicon.other > 2 and got
    for i, own in norm.items():
        lexicon.told([(np.array([x.g for x in got.get(i, [])], np.int64), np.array([x.n for x in got.get(i, [])], np.int64))])
        words = sorted(w for w in own if held[w] > 1)
        n = np.array([held[w] for w in words], np.int64)
        assert np.allclose(lexicon.idf(np.array(words, np.uint64)), np.log1p((lexicon.n - n + 0.5) / (n + 0.5)))
    assert {"packing-survey", "packing-counts", "packing-rare"} == set(plans)
    assert not any(x in p for p in plans.values() for x in ("Join", "Generate")) and "text#" not in plans["packing-rare"]


def test_packing_brings_distant_relatives_together(spark):
    """Copies with a few changed words stand far apart in the table and yet, mostly, in one window."""
    rng = random.Random(2)
    base = [[f"w{rng.randrange(3000)}" for _ in range(60)] for _ in range(150)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        w = list(w)
        w[rng.randrange(60)] = "changed"
        rows.append((1000 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartitionByRange(4, "doc_id")
    at = defaultdict(set)
    for r in packing.pack_documents(df, WORD, window=512, shard_bytes=20_000).collect():
        at[r.doc_id].add(r.sequence_id)
    together = sum(bool(at[i] & at[1000 + i]) for i in range(150))
    assert together >= 100


def test_quality_rules(spark):
    good = "the cat sat on the mat and the dog was in the house with a bird " * 1
    rows = [(1, good), (2, None), (3, ""), (4, "one two three"), (5, "spam eggs ham bread milk " * 30), (6, "word# " * 40), (7, "a line\n" * 5 + good), (None, good)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit("x")).withColumn("p", F.lit(1))
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    for i, t in rows:
        w = SPLIT.findall(t or "")
        win = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        rep = {p for k in range(len(w) - 4) if win[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if SPLIT.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(rep), len(lines) - len(set(lines)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or "")) and r.base_failed == (len(w) < 10 or 100 * len(rep) > 20 * len(w))
    assert got[1].kept and not any(got[i].kept for i in (2, 3, 4, 5, 6))
    assert {r.doc_id for r in quality_rules.keep_good(df).collect()} == {i for i, r in got.items() if r.kept}
    assert quality_rules.keep_good(df).columns == df.columns and quality_rules.quality_rules(df.limit(0)).count() == 0


def test_exact_dedup(spark):
    for df in (odd_documents(spark).repartition(5), documents(spark)):
        rows = df.select("doc_id", "text").collect()
        groups = defaultdict(list)
        for r in rows:
            groups["".join(SPLIT.findall(r.text or ""))].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        got = exact_dedup.exact_dedup(df, fan_in=2).collect()
        assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
        want = {hashlib.sha256(k.encode()).hexdigest(): (min(v), len(v)) for k, v in groups.items()}
        for r in got:
            best, n = want[r.text_sha256]
            assert r.group_size == n and (r.keep_id is None) == best[1] and (r.keep_id or 0) == best[2]
        assert exact_dedup.keep_first(df).count() == len(groups)
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("n,num,den,batch", [(4, 17, 20, 4 << 20), (5, 4, 5, 2000)])
def test_jaccard_classes(spark, monkeypatch, n, num, den, batch):
    monkeypatch.setattr(jaccard_join, "_TEXT_BATCH", batch)
    texts = near([t for t in ODD] + ["short one", "SHORT one", "a b c d e f g"])
    texts += [r.text for r in documents(spark).limit(60).collect()]
    sizes, roots = classes(texts, n, num, den)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("c", F.lit(1)).withColumn("mark", F.lit("x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df, n, num, den).collect()}
    assert got == {i: (s, c) for i, (s, c) in enumerate(zip(sizes, roots, strict=True))}
    if n == 5:
        assert jaccard_join.keep_one(df, n, num, den).count() == len(set(roots))
    if n == 4:
        assert jaccard_join.jaccard_classes(df.limit(0), n, num, den).count() == 0


def drifting(seeds):
    """Groups of copies of copies over words of their own; n-grams that most of a group keeps are frequent."""
    out = []
    for seed in range(seeds):
        rng = random.Random(seed)
        group = [[f"g{seed}w{i}" for i in range(rng.choice([40, 60, 90]))]]
        for k in range(24):
            t = list(rng.choice(group[-6:]))
            for _ in range(rng.choice([1, 1, 2, 3])):
                t[rng.randrange(len(t))] = f"g{seed}x{k}y{rng.randrange(10**6)}"
            group.append(t)
        out += [" ".join(t) for t in group]
    return out


@pytest.mark.parametrize("tile", [1])
def test_jaccard_links_of_drifting_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "_TILE", tile)
    texts = drifting(60)
    _, roots = classes(texts, 4, 17, 20)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df, 4, 17, 20).collect()}
    assert got == dict(enumerate(roots))


def phrases(n):
    """Texts of common phrases only, whose rows meet many others without a link; a few have a near copy."""
    rng = random.Random(5)
    known = [" ".join(f"p{i}w{j}" for j in range(4)) for i in range(12)]
    out = [" ".join(rng.choice(known) for _ in range(rng.choice([6, 6, 7, 9]))) for _ in range(n)]
    return out + [t + " end" for t in out[: n // 20]]


def test_jaccard_product_by_tiles(spark, monkeypatch):
    """Many tiles, buckets and blocks of the last product, a few pairs at a time."""
    for name, least in (("_ROWS", 16), ("_BLOCK", 30), ("_HELD", 200), ("_PAIRS", 500)):
        monkeypatch.setattr(jaccard_join, name, least)
    texts = phrases(250)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df, 4, 17, 20).collect()}
    assert got == dict(enumerate(classes(texts, 4, 17, 20)[1]))


def test_jaccard_bit_maps_rule_out_no_link():
    rng = np.random.default_rng(5)
    sets = [np.zeros(0, np.uint64)]
    for size in (1, 2, 3, 63, 64, 65, 200, 1000, 5000):
        base = rng.integers(1 << 63, size=2 * size).astype(np.uint64)
        sets += [np.unique(base[int(at * size) : size]) for at in (0, 0.05, 0.2)] + [np.unique(base[int(at * size) : int((at + 1) * size)]) for at in (0.1, 0.5, 1)]
    count = np.array([len(x) for x in sets])
    maps = jaccard_join.bit_maps(np.concatenate(sets), count).to_pylist()
    assert maps[0] is None and all(8 <= len(m) <= max(8, n / 4) for m, n in zip(maps[1:], count[1:], strict=True))
    some = [i for i in range(len(sets)) if count[i]]
    for i in some:
        for j in some:
            common = len(np.intersect1d(sets[i], sets[j]))
            most = jaccard_join.most_common(maps[i], maps[j], int(count[i]), int(count[j]))
            assert common <= most
            assert common or count[i] < 63 or 5 * most < 4 * (count[i] + count[j] - most)


def test_jaccard_pairs_that_cannot_link_move_no_sets(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=9))
    rows = []
    for _ in range(100):  # three texts with one five-word shingle of four in common
        start = [word() for _ in range(5)]
        rows += [(len(rows) + i, " ".join(start + [word() for _ in range(3)])) for i in range(3)]
    moved, write = {}, Staged.write

    def counted(self, df, tag):
        out = write(self, df, tag)
        moved[tag] = out.count()
        return out

    monkeypatch.setattr(Staged, "write", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, 4, 5).collect()}
    assert got == {i: i for i, _ in rows}
    assert moved["jaccard-pairs"] > 0 and moved["jaccard-sets"] == 0


def test_jaccard_null_ids_and_repeats(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "A b c d E f"), (None, None)]
    got = Counter(tuple(r) for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 17, 20).collect())
    assert got == Counter([(None, 3, 1), (3, 3, 1), (3, 3, 1), (1, 3, 1), (None, 0, None)])


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 101), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a bigint, b bigint"), Staged(spark)).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100}


def test_shingle_sets_of_slices():
    import pyarrow as pa

    texts = pa.array([None if i % 7 == 0 else f"Word{i} É Number {i % 9} of {i} " * (i % 5) for i in range(900)])
    whole, count = jaccard_join.shingle_sets(texts, 3)
    for step in (1, 13, 400):
        parts = [jaccard_join.shingle_sets(texts.slice(i, step), 3) for i in range(0, len(texts), step)]
        assert np.array_equal(np.concatenate([h for h, _ in parts]), whole) and np.array_equal(np.concatenate([c for _, c in parts]), count)
    assert count.tolist() == classes(texts.to_pylist(), 3, 1, 1)[0]


@pytest.mark.parametrize("window,batch", [(35, 4 << 20), (35, 2000), (6, 1)])
def test_substring_dedup(spark, monkeypatch, window, batch):
    monkeypatch.setattr(substring_dedup, "_TEXT_BATCH", batch)
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(50)}" for _ in range(60))
    texts = [t for t in ODD] + near([], n=6) + [f"x{i} {passage} y{i}" for i in range(5)] + ["rep " * 100, passage + " " + passage, "la di da " * 30]
    texts += [r.text for r in documents(spark).limit(50).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("mark", F.lit("x"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(df, window).collect()}
    assert got == dict(enumerate(removed(texts, window)))
    assert substring_dedup.substring_dedup(df.limit(0), window).count() == 0
    kept = substring_dedup.substring_dedup(df, window, carry=("spans",), verbatim=True).where("n_removed = 0").select("doc_id", "kept_text", "spans").collect()
    assert all(r.kept_text == (texts[r.doc_id] or "") and r.spans == 1 for r in kept)


def test_licenses(spark):
    mit = dict(KNOWN)["MIT"]
    british = mit.replace("license", "licence").replace("<year> <holders>", "2020, 2021 A. N. Other").upper().replace(".", " !")
    rows = [(1, mit), (2, british.replace("\n", "\n  ")), (3, mit + " more"), (4, None), (5, ""), (None, dict(KNOWN)["ISC"]), (1, mit)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("c", F.lit("x"))
    assert Counter((r.doc_id, r.license_id) for r in licenses.scan_licenses(df).collect()) == Counter([(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (None, "ISC")])
    table = spark.createDataFrame([("mine", "Some Text")], "license_id string, text string")
    assert licenses.scan_licenses(spark.createDataFrame([(1, "some  text.")], "doc_id bigint, text string"), table).first().license_id == "mine"


def test_license_digests(spark):
    """Texts of the licences, where the machine has them, with other case, spacing and owner."""
    import os

    folder = "/usr/share/common-licenses"
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    have = {f: i for f, i in files.items() if os.path.exists(f"{folder}/{f}")}
    if not have:
        pytest.skip("no licence texts here")
    rows = []
    for f, i in have.items():
        t = open(f"{folder}/{f}", encoding="utf-8").read()
        rows += [(i, t), (i, "Copyright 2031 Somebody Else\n\n" + t.upper().replace("\n", "\r\n  ")), (None, t + " and more")]
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    assert [r.license_id for r in licenses.scan_licenses(df).orderBy("doc_id").collect()] == [i for i, _ in rows]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_line_dedup(spark):
    rows = [(i, f"https://a.example/{i}", f"<p>menu</p><p>menu</p><p>text {i}</p><!-- x --><script>var a;</script>") for i in range(10)]
    rows += [(20, "https://b.example/", "<p>menu</p>"), (21, None, "<p>menu</p>"), (22, "https://A.example/x", None), (None, "https://a.example/z", "<div>rare</div>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).withColumn("lines", F.lit(1))
    got = {r.page_id: r for r in line_dedup.line_dedup(df).collect()}
    assert len(got) == len(rows) and all(got[i].lines == [f"text {i}"] and (got[i].n_lines, got[i].n_dropped) == (3, 2) for i in range(10))
    assert got[20].lines == ["menu"] and got[21].host == "" and got[22].n_lines == 0 and got[22].host == "a.example" and got[None].lines == ["rare"]
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_warc(spark):
    tricky = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"
    rows = [(1, "http://h/a?b", "same"), (2, None, "same"), (3, "http://h", tricky), (4, "http://h/é", "<p>é🙂</p>"), (5, "u", None), (6, "u", ""), (7, "http://h/1", "same"), (7, "http://h/1", "same"), (None, "n", "same")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("k", F.lit(1)).withColumn("occ", F.lit(1))
    got = warc.round_trip(df).collect()
    assert Counter((r.page_id, r.response.record_type, r.refers_to_page) for r in got) == Counter(
        [(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (6, "revisit", 5), (7, "revisit", 1), (7, "revisit", 1), (None, "revisit", 1)]
    )
    for r in got:
        html = next(h for p, _, h in rows if p == r.page_id) or ""
        assert r.response.payload_bytes == len(html.encode()) and r.response.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r.request is not None and (r.response.payload is None or bytes(r.response.payload) == html.encode())
    assert {r.response.record_type for r in warc.round_trip(df.where("page_id in (1, 2)"), min_payload=5).collect()} == {"response"}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_files(spark, tmp_path):
    """Many small files and blocks of several members; the files read without an index; one gzip stream, and plain text."""
    import gzip

    rows = [(i, f"http://h/{i}", f"page {i % 40} " * (i % 7 + 1)) for i in range(300)] + [(None, None, None)] * 50 + [(7, "http://h/7", "same")] * 3
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    index = warc.write_archives(df, str(tmp_path / "a"), file_bytes=20_000)
    blocks = index.collect()
    assert len({b.file for b in blocks}) > 3 and all(gzip.decompress(open(b.file, "rb").read()[b.offset : b.offset + b.length])[:5] == b"WARC/" for b in blocks)
    by_index, by_file = warc.read_records(index), warc.read_files(spark, str(tmp_path / "a"))
    kinds = Counter(r.record_type for r in by_index.select("record_type").collect())
    texts = {h or "" for _, _, h in rows}
    assert kinds == {"request": 353, "metadata": 353, "response": len(texts), "revisit": 353 - len(texts)}
    assert Counter(r.record_id for r in by_index.collect()) == Counter(r.record_id for r in by_file.collect()) and by_index.select("record_id").distinct().count() == 3 * 353
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in sorted({b.file for b in blocks}))
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "x.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "one" / "y.warc").write_bytes(whole)
    assert Counter(r.record_id for r in warc.read_files(spark, str(tmp_path / "one")).collect()) == Counter({r.record_id: 2 for r in by_index.collect()})
    got = warc.assemble(Staged(spark).write(by_index, "t")).collect()
    assert len(got) == 353 and sum(r.page_id is None for r in got) == 50 and all(r.request is not None and r.metadata is not None for r in got)
    assert sorted((r.response.record_type, r.refers_to_page) for r in got if r.page_id == 7) == sorted([("response", None), ("revisit", 7), ("revisit", 7)] + [("response", None)])


def test_sharding(spark):
    df = documents(spark).select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text"))
    got = sharding.shard_documents(df).collect()
    assert len(got) == df.count()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert set(slots) <= set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    by_id = {r.doc_id: r for r in sharding.shard_documents(documents(spark)).collect()}
    assert all(by_id[i].size == len(t.encode()) + 8 and by_id[i].text_crc32 == zlib.crc32(t.encode()) for i, t in texts.items())
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_sharding_confines_movement_to_changed_subtrees(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    d = df.select(*(k.alias(f"k{i + 1}") for i, k in enumerate(sharding.key_parts())))
    old, new = sharding.layout(24), sharding.layout(24, weights={5: 3.0})
    d = sharding.descend(sharding.descend(d, old, ("r0", "k0", "s0")), new, ("r1", "ra1", "s1"))
    rows = d.withColumnRenamed("k0", "ra0").select("r0", "ra0", "s0", "r1", "ra1", "s1").collect()
    moved = [r for r in rows if r.s0 != r.s1]
    assert moved and all(r.r1 == 0 for r in moved)  # shard 5 is in rack 1 of region 0
    assert all(r.ra1 == 1 for r in moved if r.r0 == 0) and all(r.s1 == 5 for r in moved if (r.r0, r.ra0) == (0, 1))
    share = Counter(r.s1 for r in rows)
    assert abs(share[5] / 20_000 - 3 / 26) < 0.015 and all(abs(n / 20_000 - 1 / 26) < 0.01 for s, n in share.items() if s != 5)
    for n in (24, 25, 27):  # one more shard takes rows only into itself
        got = sharding.shard_documents(df, leaves=sharding.layout(n), grown=sharding.layout(n + 1)).collect()
        assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {n}
        assert abs(sum(r.grown_shard == n for r in got) / 20_000 - 1 / (n + 1)) < 0.01


def test_exact_dedup_merges_sorted_runs(spark):
    rows = exact_dedup.digest_rows(documents(spark).repartition(9))
    plan = exact_dedup.merge_runs(rows, 9, fan_in=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 8 and "HashAggregate" not in plan and "Python" not in plan and "Arrow" not in plan


def clashing(spark):
    """Columns that differ in case alone, or are named as those used inside."""
    rows = [(i, f"{i % 3} " * 5 + "some words of one text that goes on and on " * (i % 2), "X", 7, "c0", "key", i) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, z string, y int, x string, w string, v int")
    return df.toDF("doc_id", "text", "Text", "_k", "c0", "key", "DOC_ID")


def test_clashing_columns(spark):
    df = clashing(spark)
    narrow = df.toDF("doc_id", "text", *"abcde").select("doc_id", "text")
    for whole in (exact_dedup.keep_first, jaccard_join.keep_one, quality_rules.keep_good):
        got, want = whole(df), whole(narrow)
        assert got.columns == df.columns
        assert Counter((r[0], r[1]) for r in got.collect()) == Counter(tuple(r) for r in want.collect())
        assert all(r[2] == "X" and r[3] == 7 and r[6] == r[0] for r in got.collect())
    for each in (exact_dedup.exact_dedup, quality_rules.quality_rules, licenses.scan_licenses, sharding.shard_documents, substring_dedup.substring_dedup):
        assert Counter(map(tuple, each(df).collect())) == Counter(map(tuple, each(narrow).collect()))
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(df.toDF("doc_id", "a", "Text", "b", "c", "d", "e"))


def test_very_long_texts(spark):
    """A text of 250 thousand words, beside short ones, in every operator on texts."""
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(250_000))
    rows = [(1, long), (2, long.upper()), (3, "x" * 600_000), (4, "a b c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {r.doc_id: r.n_words for r in quality_rules.quality_rules(df).collect()} == {1: 250_000, 2: 250_000, 3: 1, 4: 3}
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(df).collect()} == {i: i for i in range(1, 5)}
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df, 4, 17, 20).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(df.unionByName(df.where("doc_id = 1").withColumn("doc_id", F.lit(5).cast("long")))).collect()} == {1: 250_000, 2: 0, 3: 0, 4: 0, 5: 250_000}
    check_packing(packing.pack_documents(df, WORD).collect(), df.collect(), 4096)
    want, _ = ids_of(BYTE, [t for _, t in rows])
    assert {r.doc_id: r.n_tokens for r in bpe.encode_digests(df, BYTE).collect()} == {i: len(x) for (i, _), x in zip(rows, want, strict=True)}
    assert {r.doc_id: r.size for r in sharding.shard_documents(df).collect()} == {i: len(t) + 8 for i, t in rows}
    assert {r.license_id for r in licenses.scan_licenses(df).collect()} == {None}
