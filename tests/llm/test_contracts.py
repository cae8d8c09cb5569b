"""Cases that once went wrong: special tokens, nothing to learn from, equal ids, clashing columns."""

import numpy as np

from loomspan.llm import langid, mixing, packing
from tests.llm.helpers import prose


def test_special_tokens_become_their_ids():
    ids = packing.encoder(packing.default_tokenizer())
    assert np.frombuffer(ids("hello <|endoftext|> world"), "<u4").tolist() == [31373, 220, 50256, 995]
    assert np.frombuffer(ids("<|endoftext|><|endoftext|>"), "<u4").tolist() == [50256, 50256]


def test_labelled_rows_without_letters(spark):
    rows = [(i, "1 2 3 !!", "en", "s") for i in range(8)] + [(20, "words here", None, "s")]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == 9 and {r.lang_pred for r in got} == {"und"}


def test_every_language_is_learned(spark):
    """As many languages as once passed the bound of rows a language."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(100 * i + j, " ".join([letters[i] * 3 + letters[i - 1] * 2] * 9), f"l{i:02}") for i in range(20) for j in range(6)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=40)
    assert sorted(model.langs) == [f"l{i:02}" for i in range(20)]


def test_rows_without_an_id_are_rounded_apart(spark):
    """Documents of one size and no id, told apart by their texts, are not all taken or all left."""
    rows = [(None, prose(i, 10), "a") for i in range(400)] + [(i, prose(i, 10), "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs.select(*[c.alias(n) for n, c in mixing._sizes().items()])).collect()
    for source in "ab":
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 0.05 * own[0].target


def test_stages_keep_clashing_columns(spark):
    """A user's own columns by the names that operators add come back as they were."""
    import corpus_pipeline as p

    names = ["score", "lang_pred", "gone", "line_doc", "line_tag", "n_lines", "n_removed", "own", "copies", "rate", "u"]
    same = prose(50, 12)
    rows = [(i, f"{prose(i, 30)}\n{same}", "en", "s", *[f"{n}{i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    for name, stage in p.STAGES[:3]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns, name
        for r in got.collect():
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names], name


def test_equal_rows_take_what_their_rates_say(spark):
    """400 equal rows of one id a source are not all taken or all left."""
    rows = [(7, prose(1, 10), "a")] * 400 + [(8, prose(2, 10), "b")] * 400 + [(9, prose(3, 25), "c")] * 333 + [(i, prose(i, 30), "c") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (3, 17):
        mixed = mixing.mix(docs.repartition(parts).select(*[c.alias(n) for n, c in mixing._sizes().items()])).collect()
        assert len(mixed) == len(rows)
        for source in "abc":
            own = [r for r in mixed if r.source == source]
            assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 0.01 * own[0].target, source
        taken = sorted((r.doc_id, r.copies) for r in mixed)
        again = sorted((r.doc_id, r.copies) for r in mixing.mix(docs.repartition(5).select(*[c.alias(n) for n, c in mixing._sizes().items()])).collect())
        assert taken == again
    kept = mixing.mix_documents(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, n in taken for _ in range(n))


def test_a_language_of_one_repeated_text_is_learned(spark):
    spanish = "la casa grande está cerca del río y los niños juegan con el perro en la calle"
    rows = [(1, spanish, "es")] * 3000 + [(10 + i, prose(i, 40), "en") for i in range(3000)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model.langs) == ["en", "es"]
    asked = spark.createDataFrame([(1, spanish), (2, prose(5, 40))], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model).collect()}
    assert got[1][0] == "es" and got[1][1] > 0.5 and got[2][0] == "en"
