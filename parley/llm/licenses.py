"""License scans by ordered signature rules, in column expressions.

A text is reduced to its words, lower-cased, with one space between them. Rules are regular
expressions over these words, a few hundred, built from hand-written families, versions and
phrasings. A rule runs only on texts that contain its keyword. A detection is the interval of
a match; it falls if a detection of the same or a higher priority contains it, and of equal
intervals the earlier rule stays. Base phrases are counted by themselves and always stay.

Everything happens inside the row of a text: no shuffle, and no number of rows that depends
on the matches.

Nulls and edges: a null text is an empty one; without words all counts are 0, the places null
and the labels empty; equal rows stay equal rows; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Family, keyword, expression of its name in words, versions.
FAMILIES = [
    ("apache", "apache", r"apache(?: software| public)*(?: license)?", ["1.0", "1.1", "2.0"]),
    ("mit", " mit licen", r"mit licen[cs]e", []),
    ("mit", " mit x11", r"mit x11(?: licen[cs]e)?", []),
    ("mit", " mit public licen", r"mit public licen[cs]e", []),
    ("mit", "identifier mit ", r"mit", []),
    ("isc", " isc licen", r"isc licen[cs]e", []),
    ("isc", " isc public licen", r"isc public licen[cs]e", []),
    ("isc", "identifier isc ", r"isc", []),
    ("bsd-2-clause", " bsd ", r"(?:bsd 2 clause|simplified bsd|2 clause bsd)", []),
    ("bsd-2-clause", "freebsd", r"freebsd", []),
    ("bsd-3-clause", " bsd ", r"(?:bsd 3 clause|new bsd|modified bsd|revised bsd|3 clause bsd)", []),
    ("bsd-4-clause", " bsd ", r"(?:bsd 4 clause|original bsd|4 clause bsd)", []),
    ("bsd", " bsd ", r"bsd", []),
    ("gpl", "general public license", r"(?:gnu )?general public license", ["1.0", "2.0", "3.0"]),
    ("gpl", " gpl", r"(?:gnu )?gpl(?:v(?=[0-9]) ?)?", ["1.0", "2.0", "3.0"]),
    ("lgpl", "general public license", r"(?:gnu )?(?:lesser|library) general public license", ["2.0", "2.1", "3.0"]),
    ("lgpl", " lgpl", r"(?:gnu )?lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", "general public license", r"(?:gnu )?affero general public license", ["1.0", "3.0"]),
    ("agpl", " agpl", r"(?:gnu )?agpl", ["1.0", "3.0"]),
    ("gfdl", "free documentation license", r"(?:gnu )?free documentation license", ["1.1", "1.2", "1.3"]),
    ("mpl", "mozilla", r"mozilla public license", ["1.0", "1.1", "2.0"]),
    ("mpl", " mpl ", r"mpl", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", r"eclipse public license", ["1.0", "2.0"]),
    ("epl", " epl ", r"epl", ["1.0", "2.0"]),
    ("cddl", "development and distribution", r"common development and distribution license", ["1.0", "1.1"]),
    ("cddl", " cddl ", r"cddl", ["1.0", "1.1"]),
    ("cpl", "common public license", r"common public license", ["1.0"]),
    ("eupl", "european union public", r"european union public licen[cs]e", ["1.0", "1.1", "1.2"]),
    ("eupl", " eupl ", r"eupl", ["1.0", "1.1", "1.2"]),
    ("artistic", "artistic license", r"artistic license", ["1.0", "2.0"]),
    ("bsl", "boost software", r"boost software license", ["1.0"]),
    ("busl", "business source", r"business source license", ["1.1"]),
    ("ofl", "open font", r"(?:sil )?open font license", ["1.0", "1.1"]),
    ("osl", "open software license", r"open software license", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", "academic free", r"academic free license", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("ms-pl", "microsoft public", r"microsoft public license", []),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license", []),
    ("psf", "python software", r"python software foundation license", ["2.0"]),
    ("php", "php license", r"php license", ["3.0", "3.01"]),
    ("zlib", "zlib", r"zlib(?: libpng)?", []),
    ("unlicense", "unlicense", r"(?:the )?unlicense", []),
    ("wtfpl", "wtfpl", r"wtfpl", ["1.0", "2.0"]),
    ("odbl", "open database", r"open database license", ["1.0"]),
    ("odc-by", "open data commons", r"open data commons attribution license", ["1.0"]),
    ("pddl", "public domain dedication", r"(?:odc )?public domain dedication and license", ["1.0"]),
    ("cc0", " cc0 ", r"(?:creative commons )?cc0(?: universal)?", ["1.0"]),
    ("cc0", "creative commons zero", r"creative commons zero", ["1.0"]),
    ("openrail", "openrail", r"(?:creativeml |bigscience )?openrail(?: m)?", []),
]
#: Conditions of the attribution family by their words.
CONDITIONS = {
    "by": r"(?:by|attribution)",
    "by-sa": r"(?:by sa|attribution share ?alike)",
    "by-nc": r"(?:by nc|attribution non ?commercial)",
    "by-nd": r"(?:by nd|attribution no ?deriv(?:ative)?s?)",
    "by-nc-sa": r"(?:by nc sa|attribution non ?commercial share ?alike)",
    "by-nc-nd": r"(?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)",
}
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Statements without a family.
STATEMENTS = [
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}", 2),
    ("copyright", "copyright", r"copyright (?:by|holders?|notice)", 3),
    ("reserved", "rights reserved", r"(?:all|some) rights reserved", 2),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain", 1),
    ("public-domain", "public domain", r"public domain", 3),
    ("proprietary", "proprietary", r"proprietary and confidential", 1),
    ("no-redistribution", "redistribut", r"(?:do not|may not be|no) redistribut(?:e|ed|ion)", 2),
    ("warranty-disclaimer", "warrant", r"without warranty of any kind", 2),
    ("warranty-disclaimer", "provided as is", r"provided as is", 3),
    ("permissive-grant", "permission is hereby granted", r"permission is hereby granted free of charge to any person", 1),
    ("permissive-grant", "redistribution and use", r"redistribution and use in source and binary forms", 1),
]
#: Priorities: 0 a full notice, 1 a name with its version, 2 a name called a license, 3 a mention.
CONFIDENCE = [1.0, 0.8, 0.6, 0.4]
_GRANT = r"(?:(?:re)?licen[cs]ed|released|distributed|published|available|provided)(?: \S+)? under (?:the )?(?:terms (?:of|and conditions of) )?(?:the )?"
_TAG = r"spdx license identifier "
_WORD_COMES_NEXT, _WORD_WAS_BEFORE = "(?= )", "(?<= )"


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    keyword: str
    pattern: str
    priority: int


def _version(version: str) -> str:
    major, minor = version.split(".")
    return rf"(?:v(?:ersion)? ?)?{major}" + (rf"(?: {minor})?" if minor == "0" else rf" {minor}")


def rules() -> list[Rule]:
    """All rules in order; among equal intervals the earlier one stays."""
    found: list[tuple[str, str, str, int]] = []
    named = [(label, keyword, name, versions, _version) for label, keyword, name, versions in FAMILIES]
    for condition, words in CONDITIONS.items():
        for keyword, start in ((" cc ", "cc"), ("creative commons", "creative commons")):
            named.append((f"cc-{condition}", keyword, f"{start} {words}", _CC_VERSIONS, _version))
    for label, keyword, name, versions, expression in named:
        for version in sorted(versions, key=len, reverse=True):
            number = expression(version)
            then = rf"{name}(?: license)?(?: international| unported)? {number}"
            found.append((f"{label}-{version}", keyword, _GRANT + then, 0))
            found.append((f"{label}-{version}", keyword, _TAG + then + "(?: (?:only|or later))?", 0))
            found.append((f"{label}-{version}", keyword, then, 1))
        found.append((label, keyword, _TAG + name, 1))
        if keyword.startswith("identifier"):
            # a word of everyday texts, which is a name only behind the tag or a grant
            found.append((label, " under ", _GRANT + name, 1))
            continue
        found.append((label, keyword, _GRANT + name, 1))
        found.append((label, keyword, name, 3))
        found.append((label, keyword, name if "licen" in name else rf"{name}(?: public)? licen[cs]e", 2))
    found.extend((label, keyword, pattern, priority) for label, keyword, pattern, priority in STATEMENTS)
    framed = [(a, k, _WORD_WAS_BEFORE + p + _WORD_COMES_NEXT, n) for a, k, p, n in found]
    return [Rule(i, *values) for i, values in enumerate(framed)]


#: Matches that are appended to one list.
PART = 256
_SCHEMA = "array<struct<keyword:string,rules:array<struct<order:int,label:string,pattern:string,priority:int>>>>"
#: ASCII signs outside words, and capitals with their small letters.
_SIGNS = "".join(chr(c) for c in (*range(1, 48), *range(58, 65), *range(91, 97), *range(123, 128)))
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words with one space between, before and after them; one space without words."""
    # NUL cannot stand in the table of translate
    plain = F.translate(F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit(" ")), _SIGNS + _CAPITALS, " " * len(_SIGNS) + _CAPITALS.lower())
    return F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), " +", " ")


def _count_words(words: Column) -> Column:
    """Words of text in which every word has one space before it."""
    return (F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))).cast("bigint")


def _intervals(words: Column, rule: Column) -> Column:
    """struct(start, -end, priority, order, label) of every match, from the text between them."""
    matches = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    between = F.split(words, rule["pattern"], -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("own")))

    def interval(start: Column, length: Column) -> Column:
        return F.struct(
            start.alias("start"), (-(start + length)).alias("minus_end"), rule["priority"].alias("priority"),
            rule["order"].alias("order"), rule["label"].alias("label"),
        )

    interval_type = "array<struct<start:int,minus_end:int,priority:int,order:int,label:string>>"
    none = F.array().cast(interval_type)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        found = F.concat(state["found"], F.array(interval(start, pair["own"])))
        return F.struct((start + pair["own"]).alias("at"), found.alias("found"))

    def run(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["at"].alias("at"), none.alias("found")), step)
        # a list of one, so that the part is gone through once
        both = F.transform(F.array(inner), lambda i: F.struct(i["at"].alias("at"), F.concat(state["found"], F.array(i["found"])).alias("found")))
        return both[0]

    def whole(all_pairs: Column) -> Column:
        # appending copies what is there, so matches are appended in parts, and parts to the whole
        numbers = F.sequence(F.lit(0), F.floor(F.size(all_pairs) / PART).cast("int"))
        parts = F.transform(numbers, lambda i: F.slice(all_pairs, i * PART + 1, PART))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{interval_type}>").alias("found"))
        return F.aggregate(parts, begin, run, lambda state: F.flatten(state["found"]))

    # a list of one again: the pairs are made once
    return F.transform(F.array(pairs), whole)[0]


def _survivors(intervals: Column) -> Column:
    """struct(labels, best): the labels of detections that no other contains.

    In order of start, and the longer first, a detection is contained if an earlier one of the
    same or a higher priority reaches as far.
    """
    levels = len(CONFIDENCE)

    def step(state: Column, d: Column) -> Column:
        end = -d["minus_end"]
        falls = end <= F.element_at(state["reach"], d["priority"] + 1)
        reach = F.transform(state["reach"], lambda r, level: F.when(level >= d["priority"], F.greatest(r, end)).otherwise(r))
        labels = F.when(falls, state["labels"]).otherwise(F.array_union(state["labels"], F.array(d["label"])))
        best = F.when(falls, state["best"]).otherwise(F.least(state["best"], d["priority"]))
        return F.struct(reach.alias("reach"), labels.alias("labels"), best.alias("best"))

    none = F.array().cast("array<string>")
    begin = F.struct(F.array_repeat(F.lit(-1), levels).alias("reach"), none.alias("labels"), F.lit(levels).alias("best"))
    return F.aggregate(F.array_sort(intervals), begin, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best")))


def scan(docs: DataFrame, base: dict[str, str] | None = None, given: list[Rule] | None = None) -> DataFrame:
    """Word counts, places of the base phrases, labels and confidence of every text."""
    base = BASE if base is None else base
    given = rules() if given is None else given
    keywords = sorted({r.keyword for r in given})
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words_of(F.col("text")).alias("_words"))
    words = F.col("_words")
    has_key = reduce(lambda a, b: a | b, [F.contains(words, F.lit(k)) for k in keywords])
    has_base = reduce(lambda a, b: a | b, [F.contains(words, F.lit(f" {p} ")) for p in base])
    rows = rows.withColumns({"n_words": _count_words(words) - 1, "_keyed": has_key, "_based": has_base})
    # cut before every place of a phrase; a space more in front, as a cut at the very start is none
    parts = [F.split(F.concat(F.lit(" "), words), f"(?= {p} )", -1) for p in base]
    rows = rows.withColumn("_parts", F.when(F.col("_based"), F.array(*parts)))
    places, firsts, lasts, labels = [], [], [], []
    for i, label in enumerate(base.values()):
        part = F.col("_parts")[i]
        many = F.coalesce(F.size(part), F.lit(1)) - 1
        places.append(F.when(F.col("_based"), many).otherwise(0))
        # one space leads the whole, one ends it
        firsts.append(F.when(F.col("_based") & (many > 0), _count_words(part[0]) - 1))
        lasts.append(F.when(F.col("_based") & (many > 0), F.col("n_words") + 1 - _count_words(F.element_at(part, -1))))
        labels.append(F.when(F.col("_based") & (many > 0), F.lit(label)))
    rows = rows.withColumns(
        {
            "n_base": reduce(lambda a, b: a + b, places).cast("bigint"),
            "first_word": F.array_min(F.array(*firsts)),
            "last_word": F.array_max(F.array(*lasts)),
            "_base": F.array_compact(F.array(*labels)),
        }
    )
    # constant, so it is parsed once; one search for each keyword and not for each rule
    table = F.from_json(F.lit(json.dumps([{"keyword": k, "rules": [asdict(r) for r in given if r.keyword == k]} for k in keywords])), _SCHEMA)
    chosen = F.flatten(F.filter(table, lambda t: F.contains(words, t["keyword"]))["rules"])
    matching = F.filter(chosen, lambda r: F.rlike(words, r["pattern"]))
    detected = F.flatten(F.transform(matching, lambda r: _intervals(words, r)))
    rows = rows.withColumn("_found", F.when(F.col("_keyed"), _survivors(detected)))
    everything = F.array_union(F.col("_base"), F.coalesce(F.col("_found.labels"), F.array().cast("array<string>")))
    confidence = F.coalesce(F.element_at(F.array(*map(F.lit, [*CONFIDENCE, 0.0])), F.col("_found.best") + 1), F.lit(0.0))
    own = F.when(F.col("n_base") > 0, F.greatest(confidence, F.lit(0.5))).otherwise(confidence)
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(everything)), ",").alias("labels"), own.alias("score"),
    )
