import math
import re

import numpy as np
import pytest

from littoral.llm import quality

from .helpers import docs, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t", "a b c d e a b c d e", "x y\nx y\n\nx y \nz", "a a a a a a a a", "é ü # | <b>\x1c$", "p q r s t u v w x y z p q r s t u", "1 2 3 4 5\n1 2 3 4 5\n" + prose(3, 60)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert quality.base_counts(text or "")[:5] == brute(text)


def test_chi2():
    assert quality.chi2_quantile(0.95, 2) == pytest.approx(5.991464547, rel=1e-6)
    assert quality.chi2_quantile(0.975, 4) == pytest.approx(11.14328678, rel=1e-6)


def test_rejects_outliers_and_keeps_the_rest(spark):
    rows = [(i, prose(i, 60 + i), "en", f"s{i % 2}") for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in prose(900 + i, 80).split()), "en", "s0") for i in range(10)]
    rows += [(300, None, None, None), (301, "", "en", None), (302, prose(5, 40), None, None), (303, "a b " * 40, "xx", "only"), (None, prose(8, 50), "en", "s1")]
    rows += [rows[0]]
    got = quality.assess(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d, t, *_ in rows:
        r = by[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    assert {d for d, r in by.items() if not r.kept} == {*range(200, 210), 300, 301, 303}
    kept = quality.keep(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_empty(spark):
    assert quality.assess(docs(spark, [])).collect() == []


def brute_fit(x, noise):
    """Mean, covariance and log determinant of the best start, over all of ``x`` at once."""
    n, d = x.shape
    low = lambda v: np.sort(v, axis=0)[math.ceil(n / 2) - 1]
    centre = low(x)
    scale = np.sqrt((1.4826 * low(np.abs(x - centre))) ** 2 + noise)
    z = (x - centre) / scale
    length = np.linalg.norm(z, axis=1, keepdims=True)
    transforms = {"mad": 0 * z, "signs": np.divide(z, length, out=np.zeros_like(z), where=length > 0), "tanh": np.tanh(z), "moments": z}
    half, best = math.ceil((n + d + 1) * 0.5), None

    def d2(mean, cov):
        return np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)

    for start, y in transforms.items():
        mean, cov = quality.first_estimate(start, centre, scale, noise, y.mean(axis=0), np.cov(y.T, bias=True))
        cov, det = cov + np.diag(noise) * 1e-3, np.inf
        while True:
            far = d2(mean, cov)
            near = x[far <= np.sort(far)[half - 1] * (1 + 1e-12)]
            new = near.mean(axis=0), np.cov(near.T, bias=True) * quality.shrinkage(0.5) + np.diag(noise)
            fell = np.linalg.slogdet(new[1])[1] < det - quality.EPSILON
            if not fell:
                break
            (mean, cov), det = new, np.linalg.slogdet(new[1])[1]
        if best is None or det < best[0]:
            best = det, mean, cov
    near = x[d2(*best[1:]) <= quality.chi2_quantile(0.975, d)]
    return near.mean(axis=0), np.cov(near.T, bias=True) * quality.shrinkage(0.975) + np.diag(noise)


def test_estimate_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    clouds = {}
    for k in range(4):
        n = 60 + 80 * k
        mix = rng.normal(size=(4, 4)) * 0.2
        x = rng.normal(size=(n, 4)) @ mix + rng.normal(size=4)
        x[: n // 4] += rng.normal(size=4) * 4  # a far cluster
        if k == 3:
            x[: 3 * n // 4, 1] = 0.0  # a statistic that most have not
        clouds[f"l{k}", "s"] = x
    noise = np.array([0.002, 0.0001, 0.004, 0.003])
    rows = [(a, b, v.tolist(), noise.tolist()) for (a, b), x in clouds.items() for v in x]
    fitted = quality.fit(spark.createDataFrame(rows, "g_lang string, g_source string, x array<double>, t array<double>").repartition(5)).collect()
    assert len(fitted) == 4
    for r in fitted:
        x = clouds[r.g_lang, r.g_source]
        mean, cov = brute_fit(x, noise)
        got = np.linalg.inv(np.array(r.precision).reshape(4, 4))
        # Bins may put one vector more into a half: near, not the same.
        assert np.allclose(r.mean, mean, atol=0.15 * np.sqrt(np.diag(cov)).max()) and abs(np.linalg.slogdet(got)[1] - np.linalg.slogdet(cov)[1]) < 0.5
        cut = quality.chi2_quantile(quality.REJECT, 4)

        def out(m, c, x=x, cut=cut):
            return np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m) > cut

        assert (out(np.array(r.mean), got) == out(mean, cov)).mean() > 0.98
        mine = out(np.array(r.mean), got)
        assert mine[: len(x) // 4].mean() > 0.9
        # Where most lack a statistic, those that have it are far.
        assert mine[len(x) // 4 :].mean() < (0.05 if r.g_lang != "l3" else 0.4)


def test_small_groups_are_fitted_together(spark):
    rows = [(i, prose(i, 60 + i), "en", f"s{i}") for i in range(60)] + [(100, " ".join(w + "##" for w in prose(1, 90).split()), "en", "s100")]
    got = {r.doc_id: r.kept for r in quality.assess(docs(spark, rows)).collect()}
    assert all(got[i] for i in range(60)) and not got[100]
    few = {r.doc_id: r.kept for r in quality.assess(docs(spark, rows[-8:])).collect()}
    assert all(few.values())


def test_equal_texts_of_other_groups_keep_their_own_verdicts(spark):
    odd = " ".join(w + "##" for w in prose(1, 90).split())
    rows = [(i, prose(i, 60 + i), "en", "s") for i in range(50)] + [(i, prose(i, 70) .replace(" ", "# "), "xx", "s") for i in range(50)]
    rows += [(500, odd, "en", "s"), (500, odd, "en", "s"), (None, odd, "en", "s")]
    table = docs(spark, rows)
    want = sorted((str(r.doc_id), r.kept) for r in quality.assess(table).collect())
    got = sorted(str(r.doc_id) for r in quality.keep(table).collect())
    assert got == sorted(d for d, kept in want if kept) and "500" not in got
