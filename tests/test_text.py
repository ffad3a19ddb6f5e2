import time

import pytest
from pyspark.sql import functions as F

from lexmill.functions import ids, jsondoc, text

LAW = """LOI N° 2020-15 DU 28 JUIN 2020
portant organisation
Article 1er : Le premier article vise
l'article 123 du code.
Article 123 cité ici.
Article 2 : Le second article.
Fait à Cotonou, le 1er février 2020
AMPLIATIONS : PR 6"""


def articles(spark, body, **options):
    df = spark.createDataFrame([("d", body)], "document_id string, text string")
    return [tuple(a) for a in text.with_articles(df, **options).first()["articles"] or []]


def test_citation_stays_inside(spark):
    found = articles(spark, LAW)
    assert [(i, n) for i, _, n in found] == [(1, 1), (2, 2)]
    assert "Article 123 cité" in found[0][1]
    assert found[1][1].endswith("AMPLIATIONS : PR 6")


def test_stop_at_footer(spark):
    assert articles(spark, LAW, stop_at_footer=True)[1][1] == "Article 2 : Le second article."


def test_marker_forms(spark):
    body = "Article premier : contenu un\nARTICLE 2 : contenu deux\n  Art. 3 contenu trois\narticle 4 : minuscule"
    assert [a[0] for a in articles(spark, body)] == [1, 2, 3]


def test_first_number_may_be_any_and_short_articles_leave_a_gap(spark):
    body = "Article 5 : premier contenu\nArticle 2\nArticle 3 : troisième contenu"
    assert [(a[0], a[2]) for a in articles(spark, body)] == [(1, 5), (3, 3)]


@pytest.mark.parametrize("body", ["", "   ", "aucun marqueur", "\n\n"])
def test_no_article(spark, body):
    assert articles(spark, body) == []


def test_metadata(column):
    t = F.lit(LAW)
    assert column(text.law_title(t)) == "LOI N° 2020-15 DU 28 JUIN 2020"
    assert column(text.law_title(t, strict=True)) is None
    assert column(text.promulgation_city(t)) == "Cotonou"
    assert column(text.french_date(t)) == "2020-02-01"
    assert column(text.french_date(F.lit("le 3 mars 1999 ... Fait à X, le 4 avril 2001"), anchor_to_footer=True)) == "2001-04-04"


@pytest.mark.parametrize(
    "raw,iso",
    [
        ("le 29 février 2024", "2024-02-29"), ("29 février 2023", None), ("1er août 2000", "2000-08-01"),
        ("31 decembre 1999", "1999-12-31"), ("2ème fevrier 2001", None), ("32 mai 2000", None), ("sans date", None),
    ],
)
def test_french_dates(column, raw, iso):
    got = column(text.french_date(F.lit(raw)))
    assert got == ("2001-02-02" if raw.startswith("2ème") else iso)


@pytest.mark.parametrize("day,month,year,iso", [("3", "Mars", "2020", "2020-03-03"), ("31", "avril", "2020", None), ("1", "brumaire", "2020", None)])
def test_date_parts(column, day, month, year, iso):
    assert column(text.french_date_parts(F.lit(day), F.lit(month), F.lit(year))) == iso


@pytest.mark.parametrize("raw,ok", [(" 2020-01-05 ", True), ("2020-13-01", False), ("", False), ("2020-1-5", False)])
def test_iso_dates(column, raw, ok):
    assert (column(text.iso_date(F.lit(raw))) is not None) is ok


@pytest.mark.parametrize("unrolled", [0, 24])
def test_corrections_run_in_order(column, unrolled):
    rules = [("1€'", "1er"), ("livre |I", "livre II"), ("ab", "b"), ("b", "c")]
    got = column(text.apply_corrections(F.lit("le 1€' livre |I ab"), rules, unrolled))
    assert got == "le 1er livre II c"


def test_structure(column):
    full = (
        "RÉPUBLIQUE DU BÉNIN\nFraternité\nPRÉSIDENCE DE LA RÉPUBLIQUE\nLOI N° 2020-1\n"
        "L'Assemblée nationale a délibéré\nLa présente loi sera exécutée comme loi\nFait à Cotonou\nAMPLIATIONS"
    )
    assert column(text.structure_score(text.section_flags(F.lit(full)))) == pytest.approx(1.0)
    for missing in ("LOI N° 2020-1", "AMPLIATIONS", "Fraternité", "L'Assemblée nationale"):
        assert column(text.structure_score(text.section_flags(F.lit(full.replace(missing, ""))))) == pytest.approx(0.8)
    assert column(text.structure_score(text.section_flags(F.lit("")))) == 0.0
    assert column(text.structure_score(text.section_flags(F.lit(None).cast("string")))) == 0.0


def test_quality_and_routing(column):
    good = "mot " * 40
    q = text.text_quality(F.lit(good))
    assert column(q) > 0.7
    assert column(text.needs_ocr(q, F.lit(good))) is False
    assert column(text.needs_ocr(q, F.lit("court"))) is True
    assert column(text.text_quality(F.lit("  \n"))) == 0.0


def test_tokens(column):
    assert column(text.tokens(F.lit("L'Été où œuvre 12 le Straße")), ) == ["été", "œuvre", "stra"]
    assert column(text.tokens(F.lit("L'Été Straße"), "qa")) == ["été", "straße"]


def test_fences(column):
    assert column(text.strip_fences(F.lit("```json\n{}\n```"))) == "{}"
    assert column(text.strip_fences(F.lit(" {} "))) == "{}"


def test_signatories(column):
    people = [
        {"pattern": "Jean.*KOFFI", "role": "P", "name": "Jean KOFFI", "start_date": "2006-01-01", "end_date": None},
        {"pattern": "Garde", "role": "J", "name": "A", "start_date": None, "end_date": "2001-01-01"},
    ]
    both = column(text.signatories(F.lit("Le Garde, Jean B. KOFFI"), people))
    assert [(s["order"], s["name"]) for s in both] == [(1, "Jean KOFFI"), (2, "A")]
    later = column(text.signatories(F.lit("Le Garde, Jean B. KOFFI"), people, F.lit("2010-01-01").cast("date")))
    assert [s["name"] for s in later] == ["Jean KOFFI"]


def test_defects(column):
    got = column(text.defect_flags(F.lit("Articlc 1 Fait â Cotonou livre|I"), F.lit(None).cast("string")))
    assert got == ["article_misread_c", "city_accent", "pipe_in_word"]
    dated = column(text.defect_flags(F.lit("le 31 avril 2020"), F.lit(None).cast("string")))
    assert dated == ["date_not_extracted"]


def test_clean(column):
    assert column(text.clean_text(F.lit("Article 1e' x  y\n\n\n\nz\x07"))) == "Article 1er x y\n\nz"


def test_ids(column):
    assert column(ids.document_id(F.lit("loi"), F.lit(2025), F.lit(8))) == "loi-2025-8"
    assert tuple(column(ids.parse_document_id(F.lit("loi-2025-8")))) == ("loi", 2025, 8)
    assert column(ids.parse_document_id(F.lit("loi-2025"))) is None
    assert column(ids.padded_url("http://x/", F.lit("loi"), F.lit(2025), F.lit(8))) == "http://x/loi-2025-08"
    assert column(ids.padded_url("http://x/", F.lit("loi"), F.lit(2025), F.lit(18))) is None
    assert column(ids.valid_document(F.lit("loi"), F.lit("../x"))) is False
    assert column(ids.valid_document(F.lit("arrete"), F.lit("a-1-1"))) is False
    assert column(ids.status_ordinal(F.lit("EXTRACTED"))) == 3


@pytest.mark.parametrize(
    "code,number,padded,status",
    [(200, 5, None, "FETCHED"), (404, 5, 200, "FETCHED"), (404, 15, 200, "FAILED"), (429, 5, None, "RATE_LIMITED"), (404, 5, 429, "RATE_LIMITED"), (500, 1, 200, "FAILED")],
)
def test_probe(column, code, number, padded, status):
    got = column(ids.probe_status(F.lit(code), F.lit(number), F.lit(padded).cast("int")))
    assert got["status"] == status and got["exists"] is (status == "FETCHED")


def test_dialects(spark):
    rows = [
        ('{"_metadata":{"confidence":0.5,"source":"OCR"},"documentId":"a","articles":[{"index":1,"content":"x"}]}',),
        ('{"_metadata":{"confidence":0.5,"method":"OCR"},"articles":[{"number":"2","content":"y"}],"signatories":[{"name":"n","title":"t"}]}',),
        ('{"titre":"T","numero":7,"annee":2020,"articles":[{"index":3,"content":"z"}],"signataires":[{"nom":"n","fonction":"f"}]}',),
        ("{broken",),
    ]
    docs = [r["doc"] for r in jsondoc.with_document(spark.createDataFrame(rows, "json string")).collect()]
    assert [d["articles"][0]["index"] for d in docs[:3]] == [1, 2, 3]
    assert docs[1]["_metadata"]["source"] == "OCR" and docs[1]["signatories"][0]["role"] == "t"
    assert docs[2]["title"] == "T" and docs[2]["number"] == 7 and docs[2]["signatories"][0]["role"] == "f"
    assert docs[3] is None or docs[3]["articles"] is None


def test_json_quality(spark):
    rows = [
        ('{"_metadata":{"confidence":1,"source":"s","timestamp":"t"},"articles":[{"index":1},{"index":2}],"signatories":[{}]}', 0.3 + 0.09 + 0.3 + 0.1),
        ('{"articles":[{"index":1},{"index":3}]}', 0.15),
        ('{"articles":{}}', 0.0),
        ("nope", 0.0),
    ]
    df = jsondoc.with_root(spark.createDataFrame(rows, "json string, want double"))
    for r in df.select("want", jsondoc.quality_score(F.col("root")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["want"])


def test_defects_are_found_without_a_walk_along_every_word(spark):
    """The short patterns see what the long ones see; a word of 200,000 letters takes no time that grows with its square."""
    texts = ["ab|cd", "a| b", "|a", "|A", "€a", "x€ y", "été|île", "a |b", "a|", "", "|", "n|€a", "A|B", "a€B", "ab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    seen = (c.rlike(text.PIPE_SEEN) == c.rlike(text.PIPE_IN_WORD)) & (c.rlike(text.SUSPECT_SEEN) == c.rlike(text.SUSPECT_WORD))
    assert df.where(~seen).isEmpty()
    began = time.monotonic()
    long = spark.range(1).select(F.repeat(F.lit("a"), 200_000).alias("t")).select(text.defect_flags(c).alias("f")).first()["f"]
    assert long == [] and time.monotonic() - began < 10
