"""Functions in SQL against their Python namesakes."""

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import labels, text
from corpusloom.functions.pii import PATTERN_RECOGNIZERS, detect
from corpusloom.sources.sql_functions import quoted, register_functions

TEXTS = [
    None, "", "   a\tb ", "it's a \\ path\n", "Douleur thoracique intense", "VACCIN et Stroke", "ſtroke",
    "URGENCE MAXIMALE\n\nx", "urgence  mod", "différée", "max", "moderate",
    f"x{K.BODY_MARKER}body{K.ADVICE_MARKER}rest", f"{K.BODY_MARKER}only", f"{K.ADVICE_MARKER}a{K.BODY_MARKER}b",
    "write to a.b@mail.example.com or c@d.org", "le 12/03/2020",
]


def test_functions_equal_their_namesakes(spark, rows, values):
    names = register_functions(spark)
    assert register_functions(spark) == names  # again, in the same session
    frame = rows(list(enumerate(TEXTS)), "id int, text string")
    frame.createOrReplaceTempView("texts")
    got = spark.sql("""SELECT id, word_count(text), strip_text(text), lexicon_level(text), parse_level(text),
                              level_label(text), answer_body(text) FROM texts""")
    c = F.col("text")
    want = frame.select(
        "id", text.word_count(c), text.strip(c), labels.lexicon_level(c)["level"], labels.parse_level(c),
        labels.level_label(c), labels.answer_body(c))
    assert values(got) == values(want)
    spans = spark.sql("SELECT id, s.* FROM texts t, LATERAL pii_spans(t.text, 'fr') s")
    found = frame.select("id", F.inline(detect(c, F.lit("fr"), PATTERN_RECOGNIZERS)))
    assert values(spans) == values(found) and spans.count() > 2
    assert [r[0] for r in spark.sql(f"SELECT {quoted(TEXTS[3])}").collect()] == [TEXTS[3]]
