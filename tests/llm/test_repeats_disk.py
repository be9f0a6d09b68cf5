"""What is on disk when suffixes are dealt out."""

import glob

from littoral import scratch
from littoral.llm import repeats


def test_what_made_the_words_is_deleted_before_their_suffixes(spark, monkeypatch):
    names, trees = [], repeats.trees
    top = scratch.root(spark).removeprefix("file://") + "/littoral"
    before = set(glob.glob(f"{top}/*"))

    def seen(*args):
        names.extend(p.rsplit("/", 1)[1] for p in set(glob.glob(f"{top}/*")) - before)
        return trees(*args)

    monkeypatch.setattr(repeats, "trees", seen)
    passage = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"a b c {passage} d e"), (2, f"f g {passage} h i j"), (3, f"k {passage}")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove(docs).collect()}
    assert got == {1: 0, 2: 20, 3: 20}
    assert any(n.startswith("repeat-words") for n in names)
    assert not any(n.startswith(("repeat-asked", "repeat-copies", "repeat-open")) for n in names)
