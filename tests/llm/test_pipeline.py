"""The pipeline's stages, each on the one before, against brute force."""

import re
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as P  # noqa: E402
from tests.llm import test_operators as B  # noqa: E402

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{B.SF}/documents.parquet")
    now, names = docs, []
    for name, stage in P.STAGES:
        before = now.select("doc_id", "text").orderBy("doc_id").collect()
        stage(spark, now, B.SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        names.append(name)
        if name == "retrieval_packing":
            B.check_packing(now.collect(), before, 4096)
            break
        assert now.columns == P.COLUMNS
        after = {r.doc_id: r.text for r in now.select("doc_id", "text").collect()}
        if name == "exact_dedup":
            assert len(after) == len({"".join(SPLIT.findall(r.text)) for r in before})
        if name == "jaccard_join":
            _, roots = B.classes([r.text for r in before], 5, 4, 5)
            assert set(after) == {before[i].doc_id for i in set(roots)}
        if name == "substring_dedup":
            want = B.removed([r.text for r in before], 35)
            assert after == {r.doc_id: r.text if not gone else kept for r, (_, gone, kept) in zip(before, want, strict=True)}
    assert len(names) == 5
    whole = P.run(spark, B.SF)
    assert Counter(r.doc_id for r in whole.select("doc_id").distinct().collect()) == Counter(r.doc_id for r in now.select("doc_id").distinct().collect())


def check_stages(spark, docs, folder):
    """Each stage on what the one before kept, against brute force; rows are known by identifier and text."""
    now = docs
    for name, stage in P.STAGES:
        before = now.toDF(*[f"c{i}" for i in range(len(now.columns))]).select("c0", "c1").collect()
        stage(spark, now, "").write.parquet(str(folder / name))
        now = spark.read.parquet(str(folder / name))
        rows = now.collect()
        if name == "quality_rules":
            good = [r for r in before if r[1] and B.SPLIT.search(r[1])]
            assert Counter((r.doc_id, r.text) for r in rows) <= Counter(map(tuple, good))
        if name == "exact_dedup":
            best = {}
            for i, t in before:
                key = "".join(SPLIT.findall(t or ""))
                rank = (-len(t or ""), i is None, i or 0)
                best[key] = min(best.get(key, rank), rank)
            assert Counter((-len(r.text), r.doc_id is None, r.doc_id or 0) for r in rows) == Counter(best.values())
        if name == "jaccard_join":
            _, roots = B.classes([t for _, t in before], 5, 4, 5)
            named = {}
            for (i, _), root in zip(before, roots, strict=True):
                if i is not None:
                    named[root] = min(named.get(root, i), i)
            assert Counter(r.doc_id for r in rows if r.doc_id is not None) == Counter(set(named.values()))
            assert sum(r.doc_id is None for r in rows) == sum(i is None for i, _ in before)
        if name == "substring_dedup":
            want = Counter((i, t if not gone else kept) for (i, t), (_, gone, kept) in zip(before, B.removed([t for _, t in before], 35), strict=True))
            assert Counter((r.doc_id, r.text) for r in rows) == want
        if name == "retrieval_packing":
            from pyspark.sql import Row

            B.check_packing(rows, [Row(doc_id=i, text=t) for i, t in before], 4096)
        else:
            assert now.columns == P.COLUMNS


def test_stages_on_odd_rows(spark, tmp_path, monkeypatch):
    """Nulls in any column, blanks, repeats, copies, near copies, shared passages, a long text, clashing columns, many slices."""
    import random

    monkeypatch.setattr(P.jaccard_join, "_TEXT_BATCH", 3000)
    monkeypatch.setattr(P.substring_dedup, "_TEXT_BATCH", 3000)
    rng = random.Random(6)
    prose = lambda n, k: " ".join([rng.choice(["the", "of", "and", "is"]) if i % 5 == 0 else f"word{rng.randrange(k)}" for i in range(n)])
    passage = prose(60, 10_000)
    texts = [prose(80, 10_000) for _ in range(25)]
    texts += [t + " end" for t in texts[:6]] + [t.replace(" ", "  ") for t in texts[:4]] + texts[5:9] + [f"{prose(50, 9000)} {passage} {prose(50, 9000)}" for _ in range(5)]
    texts += [None, "", "  ", "one two", prose(30_000, 50_000)]
    rows = [(i if i % 11 else None, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "web", None if i % 5 == 0 else 1, "Text", i, "k") for i, t in enumerate(texts)]
    rows += rows[:5] + [(None, None, None, None, None, None, None, None)] * 2
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, a string, b int, c string"
    docs = spark.createDataFrame(rows, schema).toDF(*P.COLUMNS, "Text", "_k", "key")
    (tmp_path / "odd").mkdir()
    check_stages(spark, docs, tmp_path / "odd")
    (tmp_path / "none").mkdir()
    check_stages(spark, docs.limit(0), tmp_path / "none")
