"""Text cleaning, URL and list helpers."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The editing marker removed before tag stripping, and the
# trailing bracketed byline pattern (with Unicode \w).
EDIT_MARKER = "(*#*)"
BYLINE_PATTERN = r"(?U)[（(][\w／\/:： ]*[）)]\d{0,8}$"

# Markup removed before entities are decoded; a quoted attribute may hold ">".
MARKUP_PATTERN = (r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
                  r"""|</?[a-z!?](?:[^>"']|"[^"]*"|'[^']*')*>|<[^>]*>""")

# Photo URL separator inside one photo entry.
PHOTO_SEP = "|$@$|"

# UTM tag sets per share channel.
UTM_TAGS = {
    "FB": "utm_source=site.facebook&utm_medium=share&utm_campaign=fbuser",
    "LINE": "utm_source=LINE&utm_medium=share&utm_campaign=lineuser",
    "YOUTUBE": "utm_source=youtube&utm_medium=share&utm_campaign=youtube_meta",
    "IG": "utm_source=instagram&utm_medium=share",
}

# Category -> URL section code.
CATEGORY_CODES = {
    "政治": "aipl", "國際": "aopl", "兩岸": "acn", "產經": "aie", "證券": "asc", "科技": "ait",
    "生活": "ahel", "社會": "asoc", "地方": "aloc", "文化": "acul", "運動": "aspt", "娛樂": "amov",
}

# The pattern of POS tags kept and the punctuation classes turned into a space.
POS_KEEP = "^N|^V|Cbb|Caa|^D$"
POS_SPACE = ["COLONCATEGORY", "COMMACATEGORY", "DASHCATEGORY", "DOTCATEGORY", "ETCCATEGORY",
             "EXCLAMATIONCATEGORY", "PARENTHESISCATEGORY", "PAUSECATEGORY", "PERIODCATEGORY",
             "QUESTIONCATEGORY", "SEMICOLONCATEGORY", "SPCHANGECATEGORY", "WHITESPACE"]
# Entity classes kept.
ENTITY_KEEP = ["ORG", "GPE", "DATE", "PERSON", "EVENT", "FAC", "WORK_OF_ART", "LAW", "LOC"]


@F.arrow_udf(T.StringType())
def _decoded(texts: pa.Array) -> pa.Array:
    return pa.array([t and unescape(t) for t in texts.to_pylist()], pa.string())


def decode_references(text: Column) -> Column:
    """Numeric and all named HTML character references decoded."""
    return _decoded(text)


def strip_tags(html: Column) -> Column:
    """Visible text of an HTML fragment: script/style blocks and comments
    dropped, tags removed, character references decoded."""
    # one pass: leftmost-first alternation removes a whole script/style
    # block or comment where it starts, and any other tag
    return decode_references(F.regexp_replace(html, MARKUP_PATTERN, ""))


def clean_article(content: Column) -> Column:
    """Marker removal, tag stripping, trailing byline removal."""
    t = strip_tags(F.replace(content, F.lit(EDIT_MARKER), F.lit("")))
    return F.regexp_replace(t, BYLINE_PATTERN, "")


def topic_id(url: Column, pattern: str = r"/topic/newstopic/(\d+)\.aspx") -> Column:
    """Topic id from a topic URL, null when absent."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def article_id(url: Column, pattern: str = r"(\d{12})") -> Column:
    """First id-shaped run of digits in a URL."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def utm_url(url: Column, channel: Column) -> Column:
    """Append the channel's tag set with ``?`` or ``&``; unknown or empty
    channel leaves the URL unchanged (I8)."""
    tags = F.create_map(*[x for k, v in UTM_TAGS.items() for x in (F.lit(k), F.lit(v))])
    tag = F.try_element_at(tags, channel)
    sep = F.when(url.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    return F.when(tag.isNull(), url).otherwise(F.concat(url, sep, tag))


def category_url(category: Column, pid: Column, missing: str = "None") -> Column:
    """``code/pid`` from the category map (C5); unknown -> ``None/pid``."""
    codes = F.create_map(*[x for k, v in CATEGORY_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.concat(F.coalesce(F.try_element_at(codes, category), F.lit(missing)), F.lit("/"), pid)


def photo_url_count(photos: Column, kind: str = "extender") -> Column:
    """Sum over photos of the given type of the number of URLs in the entry;
    a missing or empty entry counts one (D11)."""
    sep = r"\|\$@\$\|"
    picked = F.filter(photos, lambda p: p["iType"] == F.lit(kind))
    return F.aggregate(picked, F.lit(0).cast("long"),
                       lambda acc, p: acc + F.size(F.split(F.coalesce(p["Photo"], F.lit("")), sep, -1)))


def attachment_count(photos: Column) -> Column:
    """Number of photo entries."""
    return F.coalesce(F.size(photos), F.lit(0))


def join_content(parts: Column) -> Column:
    """Paragraph list -> one text."""
    return F.array_join(parts, "")


def split_keywords(text: Column, sep: str = ",") -> Column:
    """Delimited keyword list -> array (I18); empty items dropped."""
    return F.filter(F.transform(F.split(text, sep, -1), lambda x: F.trim(x)), lambda x: x != "")


def pos_filter(words: Column, tags: Column) -> Column:
    """Tokens whose tag matches any kept pattern are kept, punctuation
    classes become one space, others are dropped; joined without separator (B14)."""
    zipped = F.arrays_zip(words.alias("w"), tags.alias("t"))
    mapped = F.transform(zipped, lambda z: F.when(z["t"].isin(POS_SPACE), F.lit(" "))
                         .when(z["t"].rlike(POS_KEEP), z["w"]))
    return F.array_join(F.array_compact(mapped), "")


def entity_words(entities: Column) -> Column:
    """Distinct kept entity texts longer than one character, sorted, space-joined."""
    kept = F.filter(entities, lambda e: e["type"].isin(ENTITY_KEEP) & (F.length(e["text"]) > 1))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda e: e["text"]))), " ")


def embedding_text(title: Column, kept: Column, entities: Column) -> Column:
    """Embedding input: title, kept tokens and the entity list (I16)."""
    return F.concat(title, F.lit(" "), kept, F.lit(" entities: "), entities)


def parse_name_list(raw: Column) -> Column:
    """Bracketed list (single or double quotes) or one entry per line -> array<string>."""
    trimmed = F.trim(raw)
    as_json = F.from_json(F.replace(trimmed, F.lit("'"), F.lit('"')), "array<string>")
    lines = F.filter(F.transform(F.split(trimmed, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(trimmed.startswith("["), F.coalesce(as_json, F.array().cast("array<string>"))) \
            .otherwise(lines)


def name_entries(names: Column) -> Column:
    """``name|orig|title`` or ``name|title`` -> array<struct<name, orig, title>>."""
    def one(s):
        p = F.split(s, r"\|", -1)
        three = F.size(p) >= 3
        return F.struct(F.trim(F.element_at(p, 1)).alias("name"),
                        F.when(three, F.trim(F.element_at(p, 2))).alias("orig"),
                        F.trim(F.when(three, F.element_at(p, 3)).otherwise(F.element_at(p, 2))).alias("title"))
    return F.transform(names, one)


def annotate_names(text: Column, entries: Column) -> Column:
    """Append ``（orig，title）`` / ``（title）`` after each listed name (C10), in one
    pass over the text: at each place the longest listed name that begins there
    is taken, so a short name inside a longer one is not annotated. Of entries
    with the same name the first counts."""
    named = F.filter(entries, lambda e: F.coalesce(e["name"], F.lit("")) != "")
    notes = F.transform(named, lambda e: F.struct(e["name"].alias("name"), F.concat(
        F.lit("（"), F.when(F.coalesce(e["orig"], F.lit("")) != "", F.concat(e["orig"], F.lit("，"))).otherwise(F.lit("")),
        F.coalesce(e["title"], F.lit("")), F.lit("）")).alias("note")))
    return _annotated(text, notes)


@F.arrow_udf(T.StringType())
def _annotated(texts: pa.Array, notes: pa.Array) -> pa.Array:
    out = []
    for text, some in zip(texts.to_pylist(), notes.to_pylist()):
        if text and some:
            note: dict[str, str] = {}
            for e in some:
                note.setdefault(e["name"], e["note"])
            names = re.compile("|".join(map(re.escape, sorted(note, key=len, reverse=True))))
            text = names.sub(lambda m, note=note: m[0] + note[m[0]], text)
        out.append(text)
    return pa.array(out, pa.string())


def exclude_roles(people: Column, excluded: list[str]) -> Column:
    """Person list without the excluded entries."""
    return F.array_except(people, F.array(*[F.lit(x) for x in excluded]).cast("array<string>"))


def parse_embedding(col: Column, is_text: bool) -> Column:
    """Embedding stored as JSON text -> array<double>; arrays pass through."""
    return F.from_json(col, "array<double>") if is_text else col.cast("array<double>")


def flatten_tagger(nested: Column) -> Column:
    """Per-sentence tagger arrays -> one array per article."""
    return F.flatten(nested)
