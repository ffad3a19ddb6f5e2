"""Text functions: corrections, article extraction, metadata, tokens, quality, structure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.rowwise import once

# Article markers and numbers.
ARTICLE_START = r"^\s*(Article|ARTICLE|Art\.)\s+"
ARTICLE_NUMBER = r"(?i)(?:Article|Art\.)\s+(1er|premier|\d+)"
MIN_ARTICLE_CHARS = 10

# Title, place, date and closing patterns.
TITLE = (
    r"(?imsu)^((?:loi|lot)\s+n[°o'º]?\s*\d{4}.*?)"
    r"^(?:l['’]?(?:assemblée|assemblee|asseàablée)\s+nationale|portant)"
)
CITY = (
    r"\s*Fait\s+[aàâùâ]\s+(Porto[-\s]*Novo|PORTO[-\s]*NOVO|Cotonou|COTONOU|"
    r"[A-Z][A-Za-zàâäéèêëïîôùûüçœÀÂÄÉÈÊËÏÎÔÙÛÜÇŒ]+)"
)
DATE = (
    r"(?:le\s+)?(\d{1,2})(er|ème)?\s+(janvier|février|fevrier|mars|avril|mai|juin|juillet|août|aout|"
    r"septembre|octobre|novembre|décembre|decembre)\s+(\d{4})"
)
FOOTER = r"^Fait\s+à"
STOP_WORD = "AMPLIATIONS"

# French month names, with and without accents.
MONTHS = {
    "janvier": 1,
    "février": 2,
    "fevrier": 2,
    "mars": 3,
    "avril": 4,
    "mai": 5,
    "juin": 6,
    "juillet": 7,
    "août": 8,
    "aout": 8,
    "septembre": 9,
    "octobre": 10,
    "novembre": 11,
    "décembre": 12,
    "decembre": 12,
}

# Legal terms of the two scoring variants.
LEGAL_TERMS = {
    "extractor": [
        "article", "loi", "décret", "dispositions", "promulgué", "république", "président",
        "ministre", "journal officiel", "conformément", "application", "notamment", "toutefois",
    ],
    "qa": [
        "article", "loi", "décret", "portant", "promulgué", "promulgation", "république",
        "assemblée", "nationale", "président", "ministre", "dispositions", "abroge", "modifie",
        "chapitre", "section", "ordonnance", "arrêté", "délibération", "constitution",
    ],
}

# Words of the two tokenizers, three letters at least.
WORDS = {
    "extractor": r"[a-zàâäéèêëïîôùûüÿçœæ]{3,}",
    "qa": r"\p{L}{3,}",
}

# Patterns of the five sections, tolerant of common misreadings.
SECTION_PATTERNS = {
    "republic": r"(?iu)R[EÉè][PI][UV][BI][LI][IL1][QO0][UV][EÉè]",
    "motto": r"(?iu)FRATERNITE|FRATERNITÉ",
    "presidency": r"(?iu)PR[EÉ0Oè][SI][IL1][DO0][EÉèo][NIL][CG][EÉè]",
    "title": r'(?iu)(LOI|DÉCRET|DECRET)\s*N[°ºo"O0]',
    "approval": r"(?iu)[AO0][SI][SI][EÉèo][MIL][BI][LI][EÉèo][EÉèo]\s+NATIONALE",
    "closing": (
        r"(?iu)[sS][eéèEo][rRIl][aàoO]\s+[EÉèo][XI][EÉèo][CG][UV][TI][EÉèo][EÉèo]\s+comme\s+loi"
        r"|abroge|La\s+[PI][RI][EÉèo][SI][EÉèo][NIL][TI][EÉè]\s+loi"
    ),
    "footer": r"(?iu)[FE][aàO0][IL1]T à",
    "stop": r"(?iu)AMPLIATIONS",
}

# Cleaning patterns and their replacements.
CLEANING = [
    (r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""),
    (r"\b(Article|ARTICLE)\s+1[eë€][\"']?(?:\s|$)", "Article 1er "),
    (r"\ble\s+1[eë€][\"']?(?:\s|$)", "le 1er "),
    (r"\n{3,}", "\n\n"),
    (r"[ \t]{2,}", " "),
]

# Probes for suspicious text.
EMAIL = r"^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
YEAR = r"\b(?:19|20)\d{2}\b"
SPACES, BLANK_LINES = r"[ \t]{2,}", r"\n{3,}"
PIPE_IN_WORD = r"[a-zA-Zàâäéèêëïîôùûüÿæœç]+\|[a-zA-Zàâäéèêëïîôùûüÿæœç]+"
ARTEFACT = r"[a-zA-Zàâäéèêëïîôùûüÿæœç]*[€îïË][a-zA-Zàâäéèêëïîôùûüÿæœç]+"
SUSPECT_WORD = r"[a-zàâäéèêëïôùûüÿæœç]*[|€][a-zàâäéèêëïôùûüÿæœç]+"
# Found in the same texts as the two before, without a walk along every word.
PIPE_SEEN = r"[a-zA-Zàâäéèêëïîôùûüÿæœç]\|[a-zA-Zàâäéèêëïîôùûüÿæœç]"
SUSPECT_SEEN = r"[|€][a-zàâäéèêëïôùûüÿæœç]"
DEFECTS = {
    "article_misread_c": "Articlc",
    "article_misread_l": "Arlicle",
    "article_misread_f": "Articfe",
    "republic_misread": "REPUBLIOU",
    "assembly_misread": "ASSEÎVIBLEÉ",
    "city_accent": "Fait â Cotonou",
}

# Whitespace and control characters removed around an article body.
_BLANK = "".join(chr(c) for c in range(1, 33))


def apply_corrections(text: Column, rules: Sequence[tuple[str, str]], unrolled: int = 24) -> Column:
    """Literal replacements in rule order; later rules see the result of earlier ones.

    Short rule lists become nested `replace` calls; long ones one fold over a literal array, which
    keeps the generated code small.
    """
    if len(rules) <= unrolled:
        return reduce(lambda col, r: F.replace(col, F.lit(r[0]), F.lit(r[1])), rules, text)
    pairs = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(c).alias("c")) for w, c in rules])
    return F.aggregate(pairs, text, lambda acc, r: F.replace(acc, r["w"], r["c"]))


def lines(text: Column) -> Column:
    """Lines of a text without trailing empty lines."""
    return F.split(F.rtrim(text, F.lit("\n")), "\n", -1)


def article_number(line: Column) -> Column:
    found = F.lower(F.regexp_extract(line, ARTICLE_NUMBER, 1))
    return F.when(found.isin("1er", "premier"), F.lit(1)).when(found != "", found.try_cast("int"))


def article_markers(text_lines: Column) -> Column:
    """array(struct(line, number)) of marker lines that carry a number, in order."""
    numbered = F.transform(
        text_lines,
        lambda s, i: F.struct(
            i.alias("line"), F.when(s.rlike(ARTICLE_START), article_number(s)).alias("number")
        ),
    )
    return F.filter(numbered, lambda m: m["number"].isNotNull())


def accepted_markers(markers: Column) -> Column:
    """Greedy numbering: the first marker opens article 1, later ones only if they continue it."""
    start = F.array().cast("array<struct<line:int,number:int>>")
    return F.aggregate(
        markers,
        start,
        lambda acc, m: F.when(
            (F.size(acc) == 0) | (m["number"] == F.size(acc) + 1), F.concat(acc, F.array(m))
        ).otherwise(acc),
    )


def articles_from_lines(text_lines: Column, accepted: Column) -> Column:
    """array(struct(index, content, printed_number)); an article runs to the next accepted marker."""
    bodies = F.transform(
        accepted,
        lambda m, k: F.struct(
            (k + 1).alias("index"),
            F.btrim(
                F.array_join(
                    F.slice(
                        text_lines,
                        m["line"] + 1,
                        F.coalesce(F.get(accepted, k + 1)["line"], F.size(text_lines)) - m["line"],
                    ),
                    "\n",
                ),
                F.lit(_BLANK),
            ).alias("content"),
            m["number"].alias("printed_number"),
        ),
    )
    return F.filter(bodies, lambda a: F.length(a["content"]) > MIN_ARTICLE_CHARS)


def with_articles(df, text: str = "text", out: str = "articles", stop_at_footer: bool = False):
    """Add the extracted articles of each text.

    Lines, accepted markers and articles are each computed once per row. With
    `stop_at_footer` the closing block is kept out of the last article.
    """
    split = lines(F.col(text))
    if stop_at_footer:
        whole = lines(F.col(text))
        footer = F.array_position(F.transform(whole, lambda s: s.rlike(FOOTER)), True)
        split = F.when(footer > 0, F.slice(whole, 1, footer.cast("int") - 1)).otherwise(whole)
    cut = once(df, __lines=split)
    found = once(cut, __accepted=accepted_markers(article_markers(F.col("__lines"))))
    return once(
        found, **{out: articles_from_lines(F.col("__lines"), F.col("__accepted"))}
    ).drop("__lines", "__accepted")


def law_title(text: Column, strict: bool = False) -> Column:
    """Title line(s) up to the approval formula; `strict` gives null, as no title is ever found."""
    if strict:
        return F.lit(None).cast("string")
    return F.nullif(F.btrim(F.regexp_extract(text, TITLE, 1), F.lit(_BLANK)), F.lit(""))


def promulgation_city(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, CITY, 1)), F.lit(""))


def french_date(text: Column, anchor_to_footer: bool = False) -> Column:
    """ISO text of the first French date in the text (or after the footer); null if impossible."""
    pattern = r"(?s)Fait\s+[aàâ].*?" + DATE if anchor_to_footer else DATE
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])

    def iso_of(found: Column) -> Column:
        day = F.regexp_extract(found, DATE, 1)
        month = months[F.regexp_extract(found, DATE, 3)]
        year = F.regexp_extract(found, DATE, 4)
        iso = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
        return F.when(day != "", F.date_format(F.try_to_date(iso, "yyyy-MM-dd"), "yyyy-MM-dd"))

    # The text is searched once; an array of one keeps the short match from being searched for again for each part.
    return F.get(F.transform(F.array(F.regexp_extract(text, pattern, 0)), iso_of), F.lit(0))


def french_date_parts(day: Column, month: Column, year: Column) -> Column:
    """ISO text from day, French month name and year."""
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    iso = F.concat_ws(
        "-",
        F.lpad(year.cast("string"), 4, "0"),
        F.lpad(months[F.lower(month)].cast("string"), 2, "0"),
        F.lpad(day.cast("string"), 2, "0"),
    )
    known = months[F.lower(month)].isNotNull() & day.isNotNull() & year.isNotNull()
    return F.when(known, F.date_format(F.try_to_date(iso, "yyyy-MM-dd"), "yyyy-MM-dd"))


def iso_date(value: Column) -> Column:
    """Date of a trimmed ISO text; anything else is null."""
    text = F.trim(value)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def tokens(text: Column, variant: str = "extractor") -> Column:
    """Lower-case words of at least three letters, in text order.

    Matching the words is several times faster than splitting at what lies between them.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS[variant]), F.lit(0))


def legal_term_count(text: Column, terms: Sequence[str] | None = None, variant: str = "extractor") -> Column:
    """How many of the listed terms occur in the text."""
    lowered = F.lower(text)
    hits = [lowered.contains(t).cast("int") for t in (terms or LEGAL_TERMS[variant])]
    return F.coalesce(reduce(lambda a, b: a + b, hits), F.lit(0))


def section_flags(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """struct of the five section flags."""
    found = {k: F.coalesce(text.rlike(p), F.lit(False)) for k, p in (patterns or SECTION_PATTERNS).items()}
    return F.struct(
        (found["republic"] & found["motto"] & found["presidency"]).alias("header"),
        found["title"].alias("title"),
        found["approval"].alias("approval"),
        found["closing"].alias("closing"),
        (found["footer"] & found["stop"]).alias("footer"),
    )


def structure_score(flags: Column) -> Column:
    names = ["header", "title", "approval", "closing", "footer"]
    return reduce(lambda a, b: a + b, [flags[n].cast("int") for n in names]) / F.lit(5.0)


def text_quality(text: Column) -> Column:
    """Share of letters and digits plus a capped share of white space."""
    size = F.length(text)
    valid = F.length(F.regexp_replace(text, r"[^\p{L}\p{Nd}]", ""))
    blank = F.length(F.regexp_replace(text, r"[^ \t\n\r\f\x0B]", ""))
    score = valid / size * 0.7 + F.least(blank / size, F.lit(0.2)) * 1.5
    return F.when(F.length(F.btrim(text, F.lit(_BLANK))) > 0, score).otherwise(F.lit(0.0))


def needs_ocr(quality: Column, first_page: Column, threshold: float = 0.70) -> Column:
    """False when the embedded text can be kept."""
    keep = (quality >= threshold) & (F.length(F.btrim(first_page, F.lit(_BLANK))) > 50)
    return ~F.coalesce(keep, F.lit(False))


def clean_text(text: Column) -> Column:
    return reduce(lambda col, r: F.regexp_replace(col, r[0], r[1]), CLEANING, text)


def defect_flags(text: Column, extracted_date: Column | None = None) -> Column:
    """Sorted-by-definition array of the misreadings seen in a text."""
    probes = [F.when(text.contains(probe), F.lit(name)) for name, probe in DEFECTS.items()]
    if extracted_date is not None:
        probes.append(F.when(text.rlike(DATE) & extracted_date.isNull(), F.lit("date_not_extracted")))
    probes.append(F.when(text.rlike(PIPE_SEEN), F.lit("pipe_in_word")))
    probes.append(F.when(text.rlike(SUSPECT_SEEN), F.lit("suspect_word")))
    return F.array_compact(F.array(*probes))


def probe_counts(text: Column) -> Column:
    """struct of how often each cleaning probe matches."""
    probes = {
        "n_years": YEAR,
        "n_space_runs": SPACES,
        "n_blank_runs": BLANK_LINES,
        "n_pipe_words": PIPE_IN_WORD,
        "n_artefacts": ARTEFACT,
    }
    return F.struct(*[F.regexp_count(text, F.lit(p)).alias(name) for name, p in probes.items()])


def is_email(value: Column) -> Column:
    return F.coalesce(value.rlike(EMAIL), F.lit(False))


def signatories(text: Column, patterns: Sequence[dict], promulgated: Column | None = None) -> Column:
    """array(struct(order, role, name, mandate_start, mandate_end)) of patterns found, in list order.

    Patterns are literals, compiled once per task; no join is involved. With `promulgated` a
    signatory also has to hold office on that date.
    """
    found = []
    for p in patterns:
        start, end = (F.lit(p.get(k)).cast("date") for k in ("start_date", "end_date"))
        hit = text.rlike(p["pattern"])
        if promulgated is not None:
            hit = hit & (promulgated >= F.coalesce(start, promulgated)) & (
                promulgated <= F.coalesce(end, promulgated)
            )
        found.append(
            F.when(
                hit,
                F.struct(
                    F.lit(p["role"]).alias("role"),
                    F.lit(p["name"]).alias("name"),
                    start.alias("mandate_start"),
                    end.alias("mandate_end"),
                ),
            )
        )
    listed = F.array_compact(F.array(*found))
    return F.transform(listed, lambda s, i: s.withField("order", i + 1))


def strip_fences(text: Column) -> Column:
    """Remove a code fence around a reply."""
    opened = F.regexp_replace(F.btrim(text, F.lit(_BLANK)), r"^(?:```json)?(?:```)?", "")
    return F.btrim(F.regexp_replace(opened, r"```$", ""), F.lit(_BLANK))


def render(template: str, *args: Column) -> Column:
    """A request text from a template with %s places."""
    return F.format_string(template, *args)


def range_label(type_: Column, year: Column, low: Column, high: Column) -> Column:
    head = F.concat_ws(";", type_, year.cast("string"), low.cast("string"))
    return F.when(low == high, head).otherwise(F.concat(head, F.lit("-"), high.cast("string")))


def payload_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def looks_like(content: Column) -> Column:
    """Kind of a payload by its first bytes: pdf, png, jpg or unknown."""
    head = F.hex(F.substring(content, 1, 4))
    return (
        F.when(head == "25504446", "pdf")
        .when(head == "89504E47", "png")
        .when(F.substring(head, 1, 6) == "FFD8FF", "jpg")
        .otherwise("unknown")
    )
