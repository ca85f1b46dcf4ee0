import random

import numpy as np
import pytest

from conftest import as_documents
from weektide.llm.langid import Model, has_letter, identify, proportions, train
from weektide.llm.q_langid import fitted

STEMS = {
    "aa": "the and thing with that for ing tion ers".split(),
    "bb": "der und nicht schen keit heit ung ein".split(),
    "cc": "été eau oui être ent ais çon ère".split(),
}


def text_in(lang, n, rng):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(k, text_in(lang, 60, rng), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(900, None, "aa"), (901, "nothing", None)]
    return train(as_documents(spark, rows), "text", "lang")


def test_held_out_texts(model):
    rng = random.Random(2)
    langs = [lang for lang in STEMS for _ in range(30)]
    shares = proportions(model, [text_in(lang, rng.randint(6, 80), rng) for lang in langs])
    found = [model.languages[k] for k in shares.argmax(1)]
    assert np.mean([a == b for a, b in zip(langs, found, strict=True)]) >= 0.98
    assert np.allclose(shares.sum(1), 1)


def test_mixtures(model):
    rng = random.Random(3)
    mixed = text_in("aa", 60, rng) + " " + text_in("cc", 30, rng)
    share = dict(zip(model.languages, proportions(model, [mixed])[0], strict=True))
    assert share["aa"] == pytest.approx(2 / 3, abs=0.1)
    assert share["cc"] == pytest.approx(1 / 3, abs=0.1)
    assert share["bb"] == 0
    alone = proportions(model, [text_in("bb", 80, rng)])[0]
    assert (alone > 0).sum() == 1


def test_every_row_has_a_result(documents, rows, model):
    got = identify(documents, "doc_id", "text", model).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, has_letter(t))) for i, t, _ in rows)
    assert sorted(str((r.doc_id, r.lang_pred != "und")) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und")
        assert sum(p.share for p in r.proportions) == pytest.approx(float(r.lang_pred != "und"))


def test_nothing_to_learn_from_and_nothing_to_say(spark, no_documents):
    empty = train(no_documents, "text", "lang")
    assert empty.languages == []
    assert identify(no_documents, "doc_id", "text", empty).collect() == []
    one = as_documents(spark, [(1, "some words", None)])
    assert identify(one, "doc_id", "text", empty).first().lang_pred == "und"


def test_results_do_not_depend_on_neighbours(model):
    rng = random.Random(4)
    texts = [text_in(lang, n, rng) for lang in STEMS for n in (1, 3, 40)] + ["", "123"]
    together = proportions(model, texts)
    assert np.allclose(together, np.vstack([proportions(model, [t]) for t in texts]), atol=1e-6)


def test_ties_go_to_the_first_language():
    model = Model(["x", "y"], np.full((1 << 16, 2), -3.0, np.float32))
    assert proportions(model, ["abc def"]).tolist() == [[1.0, 0.0]]


def test_fit_tells_known_languages_from_others(spark):
    """Documents of the given table fit; random letters and other languages don't."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fitted(docs)
    fits = [r.fit for r in identify(docs, "doc_id", "text", model).collect() if r.fit is not None]
    assert sum(f > -1.4 for f in fits) >= 0.995 * len(fits)
    rng = random.Random(1)
    texts = [
        " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(3, 8))) for _ in range(n))
        for n in (20, 200, 2000)
    ] + ["日本語のテキストはここにあります。これは文章です。" * 5,
         "Příliš žluťoučký kůň úpěl ďábelské ódy, a všechny děti se dívaly na krásné město plné lidí"]
    odd = spark.createDataFrame(list(enumerate([*texts, "123", None])), "doc_id long, text string")
    got = {r.doc_id: r.fit for r in identify(odd, "doc_id", "text", model).collect()}
    assert all(got[k] < -1.4 for k in range(len(texts))) and got[5] is None and got[6] is None
