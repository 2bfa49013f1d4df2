"""Column functions on text: cleaning, slugs, identifiers, quotes, words and marks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

#: What ends a line: the carriage return pair or any one of these.
LINE_END = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
RARE_ENDS = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# The form of a block's id behind its mark; the predicates of relations.
BLOCK_ID = r"\^([a-z0-9-]+-ch\d+-\d+)"
PREDICATES = "extracted_from|informed_by|validated_by|invalidated_by|warned_by|defined_by|formulated_by|illustrated_by|calibrated_by"
# End of fixed values.


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: the optimizer would write it out wherever it is used, even inside loops."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without white space at either end."""
    return F.btrim(col(c), F.lit(WHITE))


def lines(c: Column | str) -> Column:
    """The lines of a text; a last line end opens no further line."""
    rare = reduce(lambda a, b: a | b, [F.contains(col(c), F.lit(e)) for e in RARE_ENDS])
    parts = F.when(rare, F.split(col(c), LINE_END)).otherwise(F.split(col(c), "\n"))
    return let(parts, lambda p: F.when((F.size(p) > 0) & (F.element_at(p, -1) == ""), F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def word_count(c: Column | str) -> Column:
    s = strip(c)
    return F.when(s == "", 0).otherwise(F.size(F.split(s, r"\s+")))


def searches(c: Column | str, pattern: str) -> Column:
    return col(c).rlike(pattern)


def is_slug(c: Column | str) -> Column:
    """Up to 80 lower-case letters and digits with single hyphens between them."""
    return F.coalesce(col(c).rlike(r"^[a-z0-9]+(-[a-z0-9]+)*\z") & (F.length(col(c)) <= 80), F.lit(False))


def clean_title(c: Column | str) -> Column:
    """Without heading marks, tags and bold marks, white space collapsed."""
    t = F.regexp_replace(col(c), r"^#+\s*", "")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    t = F.regexp_replace(t, r"\*\*(.*?)\*\*", "$1")
    return strip(F.regexp_replace(t, r"\s+", " "))


def numberless_title(c: Column | str) -> Column:
    """Without a leading section number."""
    return F.regexp_replace(strip(c), r"^\s*\d+(?:\.\d+)*\s+", "")


def two_digits(c: Column | str, width: int = 2) -> Column:
    """Zero-padded to at least ``width`` digits, never cut."""
    return F.format_string(f"%0{width}d", col(c).cast("long"))


def file_stem(title: Column | str, chapter: Column | str, kind: Column | str | None = None) -> Column:
    """A file's name for a chapter (ch-NN-...) or a part (part-NNN-...), its title cut at 60 characters."""
    safe = F.lower(strip(F.regexp_replace(col(title), r"(?U)[^\w\s-]", "")))
    safe = F.regexp_replace(F.regexp_replace(safe, r"[-\s]+", "-"), r"^-+|-+$", "")
    safe = F.substring(F.when(safe == "", "untitled").otherwise(safe), 1, 60)
    part = F.concat(F.lit("part-"), two_digits(chapter, 3), F.lit("-"), safe)
    named = F.concat(F.lit("ch-"), two_digits(chapter), F.lit("-"), safe)
    return named if kind is None else F.when(col(kind) == "part", part).otherwise(named)


def chapter_number(stem: Column | str) -> Column:
    """From ch.. and chapter.. names; 0 for bare parts; null for others."""
    n = F.regexp_extract(col(stem), r"(?i)^ch(?:apter)?[-_]?(\d+)", 1)
    return F.when(n != "", n.try_cast("int")).when(is_bare_part(stem), 0)


def is_bare_part(stem: Column | str) -> Column:
    return col(stem).rlike(r"(?i)^part[-_]?\d+$")


def unit_id(chapter: Column | str, stem: Column | str) -> Column:
    """chNN, or chNN-partNN where the name tells a part."""
    part = F.regexp_extract(col(stem), r"(?i)(?:^|[-_])part[-_]?(\d+)(?:[-_]|$)", 1)
    base = F.concat(F.lit("ch"), two_digits(chapter))
    return F.when(part == "", base).otherwise(F.concat(base, F.lit("-part"), two_digits(part.try_cast("int"))))


def block_id(slug: Column | str, chapter: Column | str, number: Column | str) -> Column:
    return F.concat(col(slug), F.lit("-ch"), two_digits(chapter), F.lit("-"), two_digits(number, 4))


def normal_slug(c: Column | str) -> Column:
    """Possessive tokens dropped and plurals of longer tokens made singular."""
    tokens = F.filter(F.split(F.lower(col(c)), "-"), lambda t: (t != "") & (t != "s"))
    plural = lambda t: (F.length(t) > 3) & t.endswith("s") & ~t.endswith("ss")
    return F.array_join(F.transform(tokens, lambda t: F.when(plural(t), F.left(t, F.length(t) - 1)).otherwise(t)), "-")


def is_clean_slug(c: Column | str) -> Column:
    """No remains of formula markup, no leading digit, at least three characters."""
    return ~col(c).rlike(r"[{}\\$<>]|operatorname|quad|overline|stdtdbtdtd|^\d") & (F.length(col(c)) >= 3)


def normal_quote(c: Column | str) -> Column:
    """Without emphasis marks, white space collapsed."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), r"[*_`]+", ""), r"\s+", " "))


def content_words(c: Column | str, extra: tuple[str, ...] = ()) -> Column:
    """The distinct lower-case words of over three characters that are no stop words."""
    found = F.transform(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"([A-Za-z][A-Za-z0-9_-]{2,})"), 1), lambda w: F.lower(w))
    stop = F.array(*map(F.lit, (*rules.STOP_WORDS, *extra)))
    return F.array_except(F.array_distinct(F.filter(found, lambda w: F.length(w) > 3)), stop)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared share of two arrays' distinct members; 0 if either is empty."""
    either = F.size(F.array_union(col(a), col(b)))
    return F.when((F.size(col(a)) == 0) | (F.size(col(b)) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(col(a), col(b))) / either)


def placeholder(c: Column | str) -> Column:
    """Whether a text holds a placeholder or a model's stock phrase."""
    return F.lower(col(c)).rlike(rules.PLACEHOLDERS.replace("W", f"[^{rules.WORD}]"))


def category(c: Column | str) -> Column:
    """The block category: the first rule that holds.

    The rules run inside an array of one member: as plain code of a stage they would make a method that
    is too long for the JIT compiler, and each rule would fold and strip the text again.
    """
    prepared = F.transform(F.array(col(c)), lambda t: F.struct(t.alias("t"), F.lower(t).alias("l"), strip(t).alias("s")))
    counted = F.transform(prepared, lambda r: F.struct(r["t"].alias("t"), r["l"].alias("l"), r["s"].alias("s"), F.split(r["l"], f"[^{rules.WORD}]+").alias("w"), F.when(r["s"] == "", 0).otherwise(F.size(F.split(r["s"], r"\s+"))).alias("n")))

    def first_rule(r: Column) -> Column:
        # conditions are written once, as SQL on named values, and bound to columns here
        terms: list[Column] = []

        def condition(value: str, pattern: str, needed: tuple[list[str], list[str]] | None = None) -> str:
            # most texts have none of a list's first words: they need no search
            term = r[value].rlike(pattern)
            if needed:
                some = [F.arrays_overlap(r["w"], F.array(*map(F.lit, needed[0])))] if needed[0] else []
                term = reduce(lambda a, b: a | b, [*some, *(r[value].contains(x) for x in needed[1])]) & term
            terms.append(term)
            return f"#{len(terms) - 1}"

        found: Column | None = None
        for rule, name in rules.block_rules("t", "l", "s", "n", condition):
            c = _bound(rule, terms, r["n"])
            found = F.when(c, name) if found is None else found.when(c, name)
        return found.otherwise(rules.TRANSITION)

    return F.get(F.transform(counted, first_rule), F.lit(0))


def _bound(rule: str, terms: list[Column], count: Column) -> Column:
    """The column for a rule of terms #k and bounds on n, joined by AND and OR."""

    def term(t: str) -> Column:
        t = t.strip(" ()")
        if t.startswith("#"):
            return terms[int(t[1:])]
        _, sign, bound = t.split()
        return count >= int(bound) if sign == ">=" else count <= int(bound)

    parts = [reduce(lambda a, b: a | b, map(term, p.split(" OR "))) for p in rule.split(" AND ")]
    return reduce(lambda a, b: a & b, parts)


def lane_task_id(lane: Column | str, unit: Column | str) -> Column:
    """Camel case of lane and unit; over 32 characters a digest replaces the end."""
    camel = lambda c: F.array_join(F.transform(F.filter(F.split(col(c), r"[^A-Za-z0-9]+"), lambda w: w != ""), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 20))), "")
    name = F.concat(camel(lane), camel(unit))
    digest = F.upper(F.left(F.sha1(F.concat(col(lane), F.lit(":"), col(unit)).cast("binary")), F.lit(6)))
    return F.when(F.length(name) <= 32, name).otherwise(F.concat(F.left(name, F.lit(26)), digest))


def asset_name(url: Column | str) -> Column:
    """crop-, 16 hexadecimal digits of the address's SHA-1, and its extension (.png if none)."""
    kind = F.regexp_extract(F.lower(F.regexp_replace(col(url), r"[?#].*$", "")), r"(\.(?:png|jpe?g|webp|gif))$", 1)
    return F.concat(F.lit("crop-"), F.left(F.sha1(col(url).cast("binary")), F.lit(16)), F.when(kind == "", ".png").otherwise(kind))


def is_remote(ref: Column | str, folded: bool = True) -> Column:
    """Whether a reference leads elsewhere; the verifier's form is case-sensitive and knows mailto."""
    return col(ref).rlike(r"(?i)^(https?:|data:)" if folded else r"^(https?:|data:|mailto:)")


def basename(ref: Column | str) -> Column:
    return F.substring_index(F.replace(col(ref), F.lit("\\"), F.lit("/")), "/", -1)


def strip_ref(ref: Column | str) -> Column:
    """An image reference without quotes around it and, unless it is a path of its own kind, without a title after it."""
    bare = F.btrim(F.btrim(strip(ref), F.lit('"')), F.lit("'"))
    return F.when(bare.contains(" ") & ~bare.rlike(r"^(/|\./|\.\./)"), F.split(strip(bare), r"\s+")[0]).otherwise(bare)


def file_ref(ref: Column | str) -> Column:
    """The file that an image reference names, without fragment and query."""
    return F.regexp_replace(strip_ref(ref), r"[#?].*$", "")


def is_image_url(url: Column | str) -> Column:
    """Whether an address leads to an image or a crop."""
    u = F.lower(col(url))
    path = F.url_decode(F.regexp_replace(F.regexp_replace(u, r"^https?://[^/?#]*", ""), r"[?#].*$", ""))
    host = F.regexp_extract(u, r"^https?://([^/?#]*)", 1)
    return u.rlike("^https?://") & (path.rlike(r"\.(png|jpe?g|webp|gif)$") | path.contains("ocr/crop") | u.contains("ocr%2fcrop") | path.contains("/crop/") | host.contains("maas-watermark"))


def allowed_asset(url: Column | str, hosts: tuple[str, ...]) -> Column:
    """Whether an address is on one of the hosts or below them, by HTTPS."""
    host = F.lower(F.parse_url(col(url), F.lit("HOST")))
    below = reduce(lambda a, b: a | b, [(host == h) | host.endswith(f".{h}") for h in hosts])
    return F.coalesce((F.parse_url(col(url), F.lit("PROTOCOL")) == "https") & below, F.lit(False))


def without_frontmatter(c: Column | str) -> Column:
    """What follows the second fence of a text that begins with one."""
    return F.when(col(c).startswith("---") & (F.size(F.split(col(c), "---", 3)) == 3), F.split(col(c), "---", 3)[2]).otherwise(col(c))


def quote_lines(c: Column | str) -> Column:
    """Lines quoting the author: they begin with >, embed nothing and have at least 20 characters."""
    return F.size(F.filter(F.transform(lines(c), strip), lambda x: x.startswith(">") & ~x.contains("![[") & (F.length(x) >= 20)))


def sections(c: Column | str) -> Column:
    """Names of the second-level headings."""
    return F.regexp_extract_all(col(c), F.lit(r"(?md)^##\s+(.+?)\s*$"), 1)


def hygiene(c: Column | str) -> Column:
    """The evidence defects of a text: bracketed ids, extra brackets, predicates without anchor, a wrong predicate."""
    checks = {
        "bracketed block id": r"\^\[[a-z0-9-]+-ch\d+-\d+\]",
        "extra bracket": r"!\[\[[^\]\n]+#\^[^\]\n]+\]\]\]",
        "predicate without anchor": rf"(?md)^-\s+(?:{PREDICATES})::\[\[[^\]#]+\]\]",
        "related_to for relates_to": r"(?md)^-\s+related_to::",
    }
    return F.array_compact(F.array(*(F.when(col(c).rlike(p), F.lit(k)) for k, p in checks.items())))


def page_quality(n_sections: Column | str, n_quotes: Column | str, n_blocks: Column | str, wanted: int) -> Column:
    """Half for the sections found, the rest for up to four quotes and eight blocks; two decimals."""
    part = lambda c, most: F.least(F.lit(1.0), col(c) / most)
    return F.bround(0.5 * col(n_sections) / wanted + 0.3 * part(n_quotes, 4) + 0.2 * part(n_blocks, 8), 2)


def capped_confidence(c: Column | str) -> Column:
    return F.least(F.lit(0.95), F.coalesce(F.nullif(col(c), F.lit(0.0)), F.lit(0.5)))


def is_synthetic_id(value: Column | str, planned: Column | str) -> Column:
    """Whether a run's id is the planned one or made up."""
    return (col(value) == col(planned)) | col(value).rlike(r"(?i)(^|[-_:])(fake|mock|test|synthetic|placeholder)([-_:]|$)")


def optional_tokens(v: Column | str) -> Column:
    """A count of tokens in JSON (variant): null, or a number of 0 or more, cut to a whole one; anything else raises an error."""
    kind = F.coalesce(F.schema_of_variant(col(v)), F.lit("VOID"))
    number = F.expr(f"try_variant_get({v}, '$', 'double')") if isinstance(v, str) else F.try_variant_get(v, "$", "double")
    good = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|INT|SMALLINT|TINYINT)$") & (number >= 0)
    return F.when(kind == "VOID", F.lit(None).cast("long")).when(good, F.floor(number).cast("long")).otherwise(F.raise_error(F.lit("a count of tokens must be a number of 0 or more")).cast("long"))


def unit_title(c: Column | str, fallback: Column | str) -> Column:
    """The first title entry in 30 lines, else the first heading in 50, else the fallback."""
    rows = lines(c)
    entry = F.get(F.filter(F.slice(rows, 1, 30), lambda x: strip(x).startswith("title:")), F.lit(0))
    heading = F.get(F.filter(F.slice(rows, 1, 50), lambda x: x.startswith("#")), F.lit(0))
    bare = F.btrim(F.btrim(strip(F.regexp_replace(entry, r"^[^:]*:", "")), F.lit('"')), F.lit("'"))
    found = F.when(entry.isNotNull(), bare).otherwise(strip(F.regexp_replace(heading, r"^#+\s*", "")))
    return F.coalesce(F.nullif(found, F.lit("")), col(fallback))


def vault_ref(path: Column | str) -> Column:
    """How links name a file: its path without the extension, with forward slashes."""
    return F.regexp_replace(F.replace(col(path), F.lit("\\"), F.lit("/")), r"\.md$", "")


def is_under(path: Column | str, folder: Column | str) -> Column:
    """Whether a path is a folder or lies in it."""
    return (col(path) == col(folder)) | F.startswith(col(path), F.concat(col(folder), F.lit("/")))


def rendered_lines(c: Column | str) -> Column:
    """How many lines a written text takes: its line feeds, and one more without a last one."""
    t = F.coalesce(col(c), F.lit(""))
    return F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + F.when((t == "") | t.endswith("\n"), 0).otherwise(1)


def block_citations(c: Column | str) -> Column:
    """The ids of all blocks that a text cites, in order."""
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(BLOCK_ID), 1)


def block_embeds(c: Column | str) -> Column:
    """The ids of all blocks that a text embeds, in order."""
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"!\[\[[^\]]+#\^([a-z0-9-]+-ch\d+-\d+)[^\]]*\]\]"), 1)
