import random

import numpy as np
import pytest

from tidelake.llm import toxicity

DOCS, LABELS = "doc_id long, text string, lang string, score string", "doc_id long, quality int, toxic int"
WORDS = "river mountain table window garden yellow paper silver orange little morning evening letter people number summer winter".split()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(WORDS, k=40)
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["idiot", "moron"])
        rows.append((i, " ".join(words), "en", None))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows, labels = corpus
    return toxicity.learn(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))


@pytest.mark.parametrize("text", ["idiot", "1d10t", "!d!ot", "idiooooot", "i d i o t", "i.d.i.o.t", "m-o-r-o-n", "m0r0n", "IDIOT", "m0ron,"])
def test_disguises_are_seen_through(model, text):
    assert toxicity.scorer(model)(f"the river and {text} of the garden") >= toxicity.REJECT


@pytest.mark.parametrize("text", [None, "", " \n", "river 2024 $100 a a a a a", "www.example.com/?q=a1b2c3", "-----", "x" * 5000, "0" * 300, "日本語 テキスト"])
def test_clean_texts_stay(model, text):
    assert toxicity.scorer(model)(text) < toxicity.REJECT


def test_viterbi_finds_the_cheapest_path(model):
    decode = toxicity.Decoder(model["costs"])

    def cost(out, channel):
        a, b, total = 0, 0, channel
        for c in out + " ":
            k = toxicity.ALPHABET.index(c)
            total += model["costs"][a, b, k]
            a, b = b, k
        return total

    def paths(arcs):
        found = [("", 0.0)]
        for options in arcs:
            found = [(o + x, c + y) for o, c in found for x, y in options if not (x == " " and (not o or o[-1] == " "))] + [(o, c + y) for o, c in found for x, y in options if x == " " and (not o or o[-1] == " ")]
        return found

    for text in ("1d10t", "m0r", "a.b", "t3x7", "aab"):
        best = min(cost(o, c) for o, c in paths(decode.arcs(text)))
        got = decode.decode(text)
        assert min(cost(o, c) for o, c in paths(decode.arcs(text)) if o.strip() == got) == pytest.approx(best)


def test_trigrams_count_all_texts(spark):
    df = spark.createDataFrame([("abab",), ("ÄB",), (None,), ("",)], "text string")
    counts = toxicity.trigram_counts(df)
    k = {c: i for i, c in enumerate(toxicity.ALPHABET)}
    assert counts[k["a"], k["b"], k["a"]] == 1 and counts[k[" "], k["a"], k["b"]] == 1 and counts[k[" "], k["ä"], k["b"]] == 1
    assert np.allclose(np.exp(-toxicity.trigram_costs(counts)).sum(axis=2), 1)


def test_scores_keep_all_rows_and_columns(spark, corpus, model):
    rows, labels = corpus
    df = spark.createDataFrame([*rows, rows[0], (None, None, None, "x")], DOCS)
    out = toxicity.scored(df, model, name="toxicity")
    assert out.columns == [*df.columns, "toxicity"] and out.count() == 402
    told = {r.doc_id: r.toxicity >= toxicity.REJECT for r in out.collect() if r.doc_id is not None}
    assert all(told[i] == bool(t) for i, _, t in labels)


def test_without_labels_or_rows(spark, corpus):
    empty = spark.createDataFrame([], DOCS)
    none = toxicity.learn(empty, spark.createDataFrame([(None, 1, 1), (3, None, None)], LABELS))
    assert none["lexicon"] == {} and toxicity.scored(empty, none, name="s").count() == 0


def test_held_out_accuracy_on_given_documents(spark):
    from tidelake.llm import registry

    # labels mark some junk texts (quality 0) toxic that hold no toxic word: nothing can tell those
    for sf, auc, recall in (("sf0.01", 0.95, 0.75), ("sf0.1", 0.97, 0.93)):
        out = registry.op5_toxicity(spark, f"/root/testdata/{sf}").where("held_out").join(spark.read.parquet(f"/root/testdata/{sf}/labels.parquet"), "doc_id").toPandas()
        assert out[out.toxic == 0].predicted.mean() <= 0.015
        out = out[out.quality == 1]
        toxic, clean = out[out.toxic == 1].score.to_numpy()[:, None], out[out.toxic == 0].score.to_numpy()
        above = (toxic > clean).mean() + 0.5 * (toxic == clean).mean()
        print(sf, above, (toxic >= toxicity.REJECT).mean(), (clean >= toxicity.REJECT).mean())
        assert above >= auc and (toxic >= toxicity.REJECT).mean() >= recall


@pytest.mark.parametrize(
    "text",
    ["i   d   i   o   t", "i / d / i / o / t", "i  d  i  o  t   m  o  r  o  n   i  d  i  o  t   m  o  r  o  n   i  d  i  o  t   m  o  r  o  n", "idi" + "o" * 200 + "t",
     "/".join(["river", "m0ron", "garden"] * 10)],
)
def test_wide_and_long_disguises_are_seen_through(model, text):
    assert toxicity.scorer(model)(f"the river and {text} of the garden") >= toxicity.REJECT


def test_stretches_are_decoded_whole(model):
    read = toxicity.Reader(model["costs"], sorted)
    said = ["".join(x) for x in read("d i s g u s t i n g m o r o n r i v e r w i n t e r s u m m e r l e t t e r")]
    assert any(len(x) > 20 and set(x) <= set("disgustingmoronriverwintersummerletter") for x in said)
    assert ["sun"] in read("(x).. 's u n' yes") and len(read("mor0,")) == 1


def test_what_is_remembered_makes_no_difference(model, monkeypatch):
    texts = ["the 1d10t and i d i o t", "a b c the idiot. m0r0n!", "i/d/i/o/t x"] * 3
    want = [toxicity.scorer(model)(t) for t in texts]
    monkeypatch.setattr(toxicity, "REMEMBERED", 1)
    assert [toxicity.scorer(model)(t) for t in texts] == want


def test_a_column_of_the_scores_name_is_no_casualty(spark, model):
    with pytest.raises(ValueError):
        toxicity.scored(spark.createDataFrame([(1, "a", "en", "7")], DOCS), model)
