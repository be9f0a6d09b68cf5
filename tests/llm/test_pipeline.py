import hashlib
import math

import numpy as np
import pytest

from littoral.llm import decontaminate as dc
from littoral.llm import quality

from .helpers import docs, prose
from .test_bpe import TIK
from .test_simhash import brute as brute_simhash
from .test_suffixes import brute as brute_suffixes

pipeline = pytest.importorskip("corpus_pipeline")

ITEM = prose(77, 40, 10**6)


def rows():
    base = [(i, prose(i, 150 + i), "en", f"s{i % 2}") for i in range(30)]
    base += [(100 + i, prose(1000 + i, 120 + i), "en", f"s{i % 2}") for i in range(60)]
    base += [(40, base[3][1], "en", "s0"), (41, base[4][1] + " x", "en", "s1"), (42, prose(42, 90) + " " + ITEM, "en", "s0"), (43, "short", "en", "s0"), (44, None, None, None), (45, "", "en", "s0"), (46, "a b " * 50, "en", "s0")]
    base += [(50 + k, prose(500 + k, 80) + "\n" + prose(9, 130) + "\n" + prose(600 + k, 80), "en", "s1") for k in range(3)]
    base += [(60, " ".join(w + "###" for w in prose(61, 80).split()), "en", "s0"), base[0]]
    return base


def test_stages_match_brute_force(spark, tmp_path):
    table = docs(spark, rows())
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [len(s) for s in pipeline.STAGES] == [2] * 5
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pipeline.run(spark, str(tmp_path)).collect())
    kept = [(r.doc_id, t) for r, t in ((r, dict((d, t) for d, t, *_ in rows())[r.doc_id]) for r in quality.assess(table).collect()) if r.kept]
    assert {43, 44, 45, 46, 60}.isdisjoint(d for d, _ in kept) and len(kept) == len(rows()) - 5
    groups = {}
    for (d, t), (_, _, c) in zip(sorted(kept, key=str), [x for x in brute_simhash(sorted(kept, key=str))]):
        groups.setdefault(c, min([(d, t)]))
    firsts = {c: next((d, t) for d, t in kept if d == c) for c in groups}
    cut = [(d, k.decode()) for d, _, _, _, k in brute_suffixes(list(firsts.values()), 200)]
    clean = [(d, t) for d, t in cut if dc.coverage(dc.words(t.encode()), dc.words(ITEM.encode()))[0] < 0.5]
    assert 42 not in dict(clean)
    want = []
    for d, t in clean:
        x = np.array(TIK.encode_ordinary(t), "<u4").tobytes()
        want.append((d, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want) and math.isfinite(len(got))


def test_empty(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []
