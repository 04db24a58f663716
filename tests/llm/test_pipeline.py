import corpus_pipeline
from tidelake.llm.shared import written

#: The smaller tables have too few labels to learn what is toxic.
SF = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    tokens = sum(len(r.text.split()) for r in docs.select("text").collect())
    assert packed.groupBy().sum("n_tokens").first()[0] == tokens


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, score string"
#: Clean words that stand in many of the given documents.
CLEAN = "the and of that with from this are was for"


def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties of ids, a very long text twice with one word changed."""
    long = [f"w{i * i % 7919}" for i in range(20_000)]
    other = [*long[:10_000], "changed", *long[10_001:]]
    rows = [
        (None, None, None, None, None, 1, None), (10, "", "en", "s", 0, 2, "x"), (11, " \n", "en", None, 2, 3, "x"), (1, CLEAN, "en", "s", None, 4, "x"), (1, CLEAN, "en", "s", None, 4, "x"),
        (2, " ".join(long), "en", "s", 1, 5, "x"), (3, " ".join(other), "en", "t", 1, 6, "x"), (4, "quite another short text", None, "t", 5, None, None), (4, "with a text of its own under the same id", None, "t", 5, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows_of_toxicity(spark):
    """All are clean: every row stays as it is, also nulls, repeats and long texts."""
    assert listed(corpus_pipeline.drop_toxic(spark, odd(spark), SF)) == listed(odd(spark))


def test_toxic_rows_go_and_repeats_are_judged_alike(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic = docs.join(labels.where("toxic = 1 and quality = 1"), "doc_id", "left_semi").limit(20)
    both = docs.unionAll(toxic).unionAll(toxic)
    kept = corpus_pipeline.drop_toxic(spark, both, SF).groupBy("doc_id").count()
    times = {r.doc_id: r["count"] for r in kept.collect()}
    ids = [r.doc_id for r in toxic.collect()]
    assert all(times.get(i, 0) in (0, 3) for i in ids) and sum(i not in times for i in ids) >= 15


def test_odd_rows_of_near_copies(spark):
    """Without words: one group, of which the smallest id stays; a repeated row stays once; of the
    long texts one; rows of the same id but other texts both."""
    kept = corpus_pipeline.drop_near_copies(spark, odd(spark), SF)
    assert kept.columns == odd(spark).columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(1, CLEAN[:5]), (2, "w0 w1"), (4, "quite"), (4, "with "), (10, "")]


def test_odd_rows_of_repeats(spark):
    """Every row stays; nulls stay null; of the long texts only what no passage of both covers is left;
    the repeated row is shorter than a passage and stays whole; n_chars follows."""
    cut = corpus_pipeline.cut_repeats(spark, odd(spark), SF)
    rows = cut.collect()
    assert len(rows) == 9 and cut.columns == odd(spark).columns
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[None][0].text is None and by[None][0].n_chars is None and by[10][0].text == "" and by[11][0].n_chars == 2
    assert [r.text for r in by[1]] == [CLEAN, CLEAN] and all(r.n_chars == len(CLEAN) for r in by[1])
    for i, word in ((2, "w100000000"), (3, "changed")):
        assert len(by[i][0].text.split()) < 200 and by[i][0].n_chars == len(by[i][0].text)
    assert "changed" in by[3][0].text and "changed" not in by[2][0].text


def test_repeated_rows_lose_a_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} start {passage} own{i} end", None, None, None, None, None) for i in (1, 1, 2)]
    cut = corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert all("p30" not in r.text for r in cut.collect()) and cut.count() == 3


def test_odd_rows_of_mixing(spark):
    """Each source's taken words come near its target, no row more than three times; rows without
    words go at their source's rate; the columns stay."""
    docs = odd(spark)
    taken = corpus_pipeline.mix_sources(spark, docs, SF)
    assert taken.columns == docs.columns
    before, after = ({}, {})
    for df, out in ((docs, before), (taken, after)):
        for r in df.collect():
            out[r] = out.get(r, 0) + 1
    assert set(after) <= set(before) and all(n <= 3 * before[r] for r, n in after.items())
    words = lambda rows: sum(n * len((r.text or "").split()) for r, n in rows.items() if r.source == "s")
    # of 40,000 words s has a half, weighs 5 of 7 and is taken up to that; the whole long text is one step
    assert abs(words(after) - words(before) * 10 / 7) <= 20_000


def test_odd_rows_of_packing(spark):
    """All words are in some chunk; rows without words take one chunk of length 0."""
    packed = corpus_pipeline.pack(spark, odd(spark), SF)
    assert packed.groupBy().sum("n_tokens").first()[0] == sum(len((r.text or "").split()) for r in odd(spark).collect())
    assert packed.where("n_tokens = 0").count() == 3


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == [] and (name == "packing" or out.columns == docs.columns)
