"""Ordered label harvest: the first pattern of a field that a text satisfies gives its value.

Patterns are literals unrolled into Column expressions, so a text is read once per
scan for all fields, in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserix.functions.text import base_name, extract, norm, quoted, snippet_around

MAX_SPAN = 400
# A language in a programme's name, and the sentence that states a degree before the programme's name.
LANGUAGE_IN_NAME = r"((?:с частично обучение )?на английски език)"
DEGREE_SENTENCE = r'(?iu)придобиват\s+(?:образователната|образователно-квалификационна)\s+степен\s*[„"«“]\s*([а-я][а-я ]*?)\s*[“”"»]\s*по\s+специалност(?:та)?\s*[„"«“]?\s*'
# Label patterns per field, in order of preference; group 1 is the value.
LABEL_PATTERNS = {
    "degree": (
        ("bg-oks-label", r'Степен:\s*(ОКС\s*[„"«][А-Яа-я ]+["”»])'),
        ("bg-oks-inline", r'(?<!образованието си в )(ОКС\s*[„"«][А-Яа-я][а-я ]*["”»])'),
        ("bg-okstepen", r'([Оо]бразователно\s*-?\s*квалификационна(?:та)? степен\s*[–-]?\s*[„"“]\s*[а-я ]+["”“])'),
        ("bg-pridobilite", r"Придобилите степен\s+([А-Я][А-Я ]+[А-Я])(?=\s+са)"),
        ("en-equal-degree", r"Educational qualification degree\s+([A-Z]+)"),
        ("vum-dual-bachelor", r"((?:accredited )?(?:Bulgarian )?Professional Bachelor degree from VUM and the British [^.]+? awarded by Cardiff Metropolitan University)"),
        ("vum-dual-master", r"(VUM Master[’']s degree in [^.]+? and the [^.]+? awarded by Cardiff Metropolitan University)"),
        ("bg-programme-level", r"[-–—]\s*(бакалавърска програма|магистърска програма|докторска програма)"),
    ),
    "duration": (
        ("bg-semestri-label", r"(Продължителност на обучението \(брой семестри\):\s*[0-9а-я]+)"),
        ("bg-srok-label", r"(Срок на обучение[^:]{0,25}:\s*\d+\s*семестъра(?:\s*\(\d+\s*учебни години\))?)"),
        ("bg-godishen", r"(\d+-годишен период на обучение(?:\s*\([^)]+\))?)"),
        ("bg-srok-godini", r"(срок на обучение\s+\d+\s+години)"),
        ("en-nmonth-nterm", r"([a-z]+-month \([a-z]+-term\))"),
        ("en-duration-label", r"Duration of training\s+(\d+\s*[–-]\s*\d+\s+semesters)"),
        ("en-years-sem", r"Professional Bachelor\s+(\d(?:\.\d)? years? / \d semesters)"),
        ("en-sem-or-sem", r"(\d semesters or \d semesters)"),
        ("bg-prodalzhitelnost", r"((?:с продължителност|[Пп]родължителността на обучението е)\s+[а-я]+(?: учебни)? години(?:\s*\([а-я]+ семестъра\))?)"),
    ),
    "language": (
        ("bg-lang-label", r"Език на преподаване(?:\\n| )+((?:БЪЛГАРСКИ|Български|български|АНГЛИЙСКИ|Английски|английски)(?:(?:(?:\\n| )+(?:И|и|ИЛИ|или)(?:\\n| )+)(?:БЪЛГАРСКИ|Български|български|АНГЛИЙСКИ|Английски|английски))?)"),
        ("en-lang-label", r"Language of instruction\s+(English|Bulgarian|ENGLISH|BULGARIAN)"),
        ("en-taught-in", r"taught entirely in (English)"),
        ("bg-dual-track", r"((?:българоезично|англоезично)(?: и (?:българоезично|англоезично))? обучение)"),
    ),
    "tuition": (
        ("en-semfee-label", r"Semester fee:\s*(\d[\d ,.]* (?:leva|лв|евро|EUR|€))"),
        ("bg-godtaksa-label", r"[Гг]одишна такса[^:]{0,20}:\s*(\d[\d ,.]*\s*(?:лв|евро|EUR|€))"),
    ),
    "admission": (
        ("bg-test-po-izbor", r"могат да кандидатстват по избор с оценката от него или с (приемен изпит-тест по [а-я]+)"),
        ("bg-konkurs-label", r"Конкурс\s*:\s*(.+?)(?=\s*(?:Обучение\s*:|Прием\s*:|Реализация\s*:|$))"),
        ("bg-priemat-chrez", r'Приемът на студенти за специалността\s*[„"“]?[^.]*?се извършва чрез\s+(.+?)(?=,\s*както и|\s+както и|\.)'),
        ("en-open-to", r"(?:programme is )?open to (candidates holding a Bachelor[’']s or Master[’']s degree from any field of study)"),
        ("en-must-demonstrate", r"Applicants must demonstrate (English language proficiency equivalent to IELTS [\d.]+ or above)"),
        ("en-required-min", r"Applicants are required to have obtained a (minimum of a bachelor[’']s degree from an accredited institution of higher education)"),
        ("en-dzi-b2", r"(?:may also be admitted based on their result from the )(State Matriculation Examination \(DZI\) in English language, provided that the exam corresponds to CEFR level B2 and the final grade is at least Very Good \(5\.00\))"),
        ("en-min-gpa", r"The (recommended minimum GPA for applicants is .+?scale\))"),
        ("bg-kandidatstva-se", r"Кандидатства се с:\s*(1\).{20,500}?\.)(?=\s+[А-Я]|\s*$)"),
    ),
}


def harvest_fields(texts: DataFrame, patterns: dict[str, Iterable[tuple[str, str]]] | None = None, skip: str | None = None, max_span: int = MAX_SPAN, keep: tuple[str, ...] = ()) -> DataFrame:
    """(ref, field, value, segments, method, tier) of the texts (ref, text[, skip]): per field the first pattern with a short enough value.

    Only a pattern's first match counts: if its value is longer than max_span the
    next pattern is tried, not the next match.  `skip` names a column of labels not
    to try.  All fields are read in one pass: every pattern is searched once per
    text, its match looked up again only where it holds.  Columns of `keep` pass on.
    """
    every = {f: list(p) for f, p in (patterns or LABEL_PATTERNS).items()}
    normed = texts.withColumn("__text", norm(F.col("text")))
    column = {(f, label): f"__{f}_{k}" for f, p in every.items() for k, (label, _) in enumerate(p)}
    searched = normed.withColumns({column[f, label]: F.regexp_extract("__text", pattern, 1) for f, p in every.items() for label, pattern in p})
    hits = []
    for f, p in every.items():
        out = F.lit(None).cast("struct<field:string,value:string,snippet:string,method:string>")
        for label, pattern in reversed(p):
            value = F.col(column[f, label])
            ok = (value != "") & (F.length(value) <= max_span)
            if skip is not None:
                ok = ok & ~F.coalesce(F.array_contains(skip, label), F.lit(False))
            whole = F.regexp_extract("__text", pattern, 0)
            at = F.instr(F.col("__text"), whole) - 1
            around = snippet_around(F.col("__text"), at, at + F.length(whole))
            out = F.when(ok, F.struct(F.lit(f).alias("field"), norm(value).alias("value"), around.alias("snippet"), F.lit(f"label:{label}").alias("method"))).otherwise(out)
        hits.append(out)
    found = searched.select("ref", *keep, F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("hit"))
    return found.select("ref", *keep, "hit.field", "hit.value", F.array("hit.snippet").alias("segments"), "hit.method", F.lit("G").alias("tier"))


def harvest_field(texts: DataFrame, field: str, patterns: Iterable[tuple[str, str]] | None = None, skip: str | None = None) -> DataFrame:
    """harvest_fields of one field."""
    return harvest_fields(texts, {field: patterns or LABEL_PATTERNS[field]}, skip)


def without_suppressed(hits: DataFrame, suppressed: DataFrame) -> DataFrame:
    """Hits (program_id, field, method, ...) without those whose label is suppressed for the programme's field."""
    labels = suppressed.select("program_id", "field", F.concat(F.lit("label:"), F.col("label")).alias("method"))
    return hits.join(labels, ["program_id", "field", "method"], "left_anti")


def language_from_name(name: Column, text: Column) -> Column:
    """struct(value, snippet): a language stated in the name itself, with the place in the text where the name stands (its start if nowhere)."""
    value = F.regexp_extract(name, LANGUAGE_IN_NAME, 1)
    at = F.greatest(F.instr(text, F.substring_index(name, " (", 1)), F.lit(1))
    first = F.greatest(at - 60, F.lit(1))
    return F.when(value != "", F.struct(value.alias("value"), norm(F.substring(text, first, at + F.length(name) + 60 - first)).alias("snippet")))


def degree_from_name(name: Column, text: Column) -> Column:
    """The degree of a sentence that names the programme; null where there is none."""
    found = extract(text, F.concat(F.lit(DEGREE_SENTENCE), quoted(name)), 1)
    return F.when(found != "", norm(found))


def degree_sentence(name: Column, text: Column) -> Column:
    """struct(value, snippet): the degree of a sentence that names the programme, with that sentence's words; null where there is none."""
    pattern = F.concat(F.lit(DEGREE_SENTENCE), quoted(name))
    return F.when(extract(text, pattern, 1) != "", F.struct(norm(extract(text, pattern, 1)).alias("value"), norm(extract(text, pattern, 0)).alias("snippet")))


def anchor_value(text: Column, pattern: Column, names_program: Column | None = None) -> Column:
    """Group 1 of a configured pattern, on pages that name the programme where that is asked."""
    found = extract(text, pattern, 1)
    ok = found != ""
    return F.when(ok if names_program is None else ok & names_program, norm(found))


__all__ = ["LABEL_PATTERNS", "anchor_value", "base_name", "degree_from_name", "harvest_field", "harvest_fields", "language_from_name", "without_suppressed"]
