"""Findings on cuts: what lies beyond them counts."""

from tickloom.llm.packing import pack
from tickloom.llm.toxicity import style_votes


def test_capitals_are_counted_over_the_whole_text():
    calm = "quiet words " * 6000
    assert len(calm) > 1 << 16 and not style_votes(calm)[0]
    assert style_votes(calm + "LOUDER WORDS " * 9000)[0]
    assert not style_votes("LOUDER WORDS " * 6000 + "quiet words " * 9000)[0]


def test_white_space_at_the_ends_makes_no_other_cluster(spark):
    rows = [(i, t, f"s{i}") for i, t in enumerate(["Foo bar", "foo bar\n", "\tfoo bar", "\r\n foo  bar \n", "foo\nbar"])]
    placed = pack(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len({r.bin_id for r in placed}) == len(placed) == 5


def test_null_and_repeated_ids_and_clashing_columns(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from tickloom.llm.language import identify
    from tickloom.llm.mixing import mix, schedule
    from tickloom.llm.quality import judge
    from tickloom.llm.simhash import one_of_each
    from tickloom.llm.toxicity import toxicity

    rows = [(None, f"some text of number {i} here", "en", "a") for i in range(6)] + [(1, "same id twice", "en", "a"), (1, "same id again", "en", None), (2, None, "en", "b"), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("_id", "_text", "_lang", "_y", "_h", "_known", "_size", "_finish", "_lap", "_nth", "_at", "quality", "kept", "fp", "h", "salt")})
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert identify(docs).count() == judge(docs, labels).count() == toxicity(docs, labels).count() == len(rows)
    assert pack(docs).where("bin_id is not null").count() == 8 and pack(docs).count() == len(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and {r["_h"] for r in kept.collect()} == {"clash"}
    mixed = mix(docs)
    assert mixed.columns == docs.columns and {r["_size"] for r in mixed.collect()} == {"clash"}
    plan = Counter()
    for r in schedule(docs).collect():
        plan[r.size, r.source] += r.passes
    assert Counter((len((r.text or "").split()), r.source) for r in mixed.collect()) == +plan
