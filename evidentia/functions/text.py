"""Text and key functions as Columns: everything stays in the JVM. Null in, null out unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions import fixed


def norm_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def first_or(c: Column, default: str = "") -> Column:
    """The first element of an array; of an empty or missing one, the default."""
    return F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(default))


def json_field(c: Column, path: str, kind: str, default: object = None) -> Column:
    """A nested field of a JSON text by its path ($.a.b); where it is missing or of another kind, the default."""
    return F.coalesce(F.get_json_object(c, path).try_cast(kind), F.lit(default).cast(kind))


def least_of(values: Column, keep, value) -> Column:
    """The least value of those elements of a nested list that are kept (null if none is): ``keep`` and ``value`` are functions of an element."""
    return F.array_min(F.transform(F.filter(values, keep), value))


def split_packed(c: Column, sep: str = "|") -> Column:
    """Packed list to array without empty parts; null is an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\\Q" + sep + "\\E"), lambda x: F.trim(x)), lambda x: x != "")


def _without_legal(c: Column, legal: list[str]) -> Column:
    """Spaces made single, and legal words off the end, be it to the last word."""
    words = "|".join(legal)
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), rf"(^|\s+)({words})(\s+({words}))*$", ""))


def organisation(c: Column, canon: list[tuple[str, str]] = (), replace: list[tuple[str, str]] = (), *, legal: list[str] = fixed.LEGAL, trustee: str = fixed.TRUSTEE) -> Column:
    """Canonical organisation: replacements, non-ASCII to space, first non-blank part of a ``;`` list, upper case without
    parentheses and punctuation, legal words off the end; then the first key of ``canon`` that is contained. Trustees and null are ''."""
    c = F.coalesce(c, F.lit(""))
    for old, new in replace:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, r"[^\x00-\x7F]+", " ")
    c = F.coalesce(F.try_element_at(F.filter(F.split(c, ";"), lambda x: F.trim(x) != ""), F.lit(1)), F.lit(""))
    c = F.regexp_replace(F.upper(c), r"\(.*?\)|[.,/]", " ")
    name = _without_legal(c, legal)
    out = F.when(c.rlike("(?i)" + trustee), F.lit(""))
    for key, owner in canon:
        out = out.when(name.contains(key), F.lit(owner))
    return out.otherwise(name)


def assignee(c: Column, *, legal: list[str] = fixed.LEGAL) -> Column:
    """The plain form of a name: upper case without parentheses, punctuation and legal words at the end."""
    return _without_legal(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"\(.*?\)|[.,/]", " "), legal)


def base_substance(c: Column, *, salts: list[str] = fixed.SALTS) -> Column:
    """Lower-cased name without trailing salt words; at least one word stays."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\s+", " "), rf"(?<=\S)( ({'|'.join(salts)}))+$", "")


def surface_form(c: Column) -> Column:
    """Symbols in upper case; phrases and long words as they are."""
    return F.when((F.length(c) <= 8) & ~c.contains(" "), F.upper(c)).otherwise(c)


def academic(c: Column, words: list[str] = fixed.ACADEMIC) -> Column:
    """Names with an academic word, or that look like a person's."""
    low = F.lower(c)
    hit = F.lit(False)
    for w in words:
        hit = hit | low.contains(w)
    return F.coalesce(hit | person_name(c), F.lit(False))


def phase_one(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)\bphase i\b"), F.lit(False))


def title_case(c: Column) -> Column:
    """Each letter after something that is no letter in upper case, the others in lower case."""
    chars = F.split(c, "")
    before = lambda i: F.coalesce(F.try_element_at(chars, i), F.lit(" "))
    return F.array_join(F.transform(chars, lambda x, i: F.when((i > 0) & before(F.greatest(i, F.lit(1))).rlike(r"\p{L}"), F.lower(x)).otherwise(F.upper(x))), "")


def nomenclature(c: Column, name: str = fixed.NOMENCLATURE, against: str = fixed.NOT_NOMENCLATURE, before: int = 28, after: int = 12) -> Column:
    """Chemical names that follow a bracket, hyphen or digit (and a space at most), each with its context, unless a word of ``against`` is in that."""
    c = F.coalesce(c, F.lit(""))
    parts = F.split(c, rf"(?i)(?<=[\])\-0-9]\s?)(?={name})")
    ends = F.aggregate(parts, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(x))))
    rest = F.slice(F.arrays_zip(parts.alias("p"), ends.alias("e")), 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def context(x: Column) -> Column:
        begin = x["e"] - F.length(x["p"])  # characters before the name
        size = F.length(F.regexp_extract(x["p"], rf"(?i)^(?:{name})", 0))
        lead = F.least(begin, F.lit(before))
        return F.regexp_replace(F.substring(c, begin - lead + 1, lead + size + after), r"^\s+|\s+$", "")

    return F.filter(F.transform(rest, context), lambda x: ~x.rlike("(?i)" + against))


def lead_names(c: Column, pattern: str = fixed.LEAD, label: str = fixed.LEAD_LABEL, data: str = fixed.LEAD_DATA) -> Column:
    """Names in the paragraphs of a description: subscripts repaired, tags unescaped, labels before and data after them cut; different ones in order."""
    paragraphs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?s)<p>(.*?)</p>"), 1)
    plain = F.transform(paragraphs, lambda p: F.trim(F.regexp_replace(unescaped(F.regexp_replace(p, r"<(\d+)>", "$1")), r"\s+", " ")))
    good = F.filter(plain, lambda p: (F.length(p) > 12) & (F.length(p) < 320) & ~p.startswith("[") & p.rlike("(?i)" + pattern))
    repaired = lambda p: F.regexp_replace(F.replace(F.replace(p, F.lit("/V"), F.lit("N")), F.lit("/v"), F.lit("N")), "(?i)" + label, "")
    return F.array_distinct(F.transform(good, lambda p: F.trim(F.element_at(F.split(repaired(p), data, 2), 1))))


def design_text(outcomes: Column, description: Column, most: int = 4000) -> Column:
    """Measures, descriptions and time frames of all outcomes (an array of structs), and the first characters of the description."""
    each = F.transform(outcomes, lambda o: F.concat_ws(" ", F.coalesce(o["measure"], F.lit("")), F.coalesce(o["description"], F.lit("")), F.coalesce(o["timeFrame"], F.lit(""))))
    return F.concat_ws(" ", F.coalesce(F.array_join(each, " "), F.lit("")), F.substring(F.coalesce(description, F.lit("")), 1, most))


def patent_url(number: Column) -> Column:
    return F.concat(F.lit("https://patents.google.com/patent/"), F.replace(F.coalesce(number, F.lit("")), F.lit("-"), F.lit("")))


def trial_url(ident: Column) -> Column:
    """European numbers begin with the year."""
    ident = F.coalesce(ident, F.lit(""))
    return F.when(ident.startswith("20"), F.concat(F.lit("https://euclinicaltrials.eu/ctis-public/#/study/"), ident)).otherwise(F.concat(F.lit("https://clinicaltrials.gov/study/"), ident))


def any_of(values: Column, pattern: str) -> Column:
    """Whether any of an array's values has the pattern; none of an empty one has."""
    return F.coalesce(F.exists(values, lambda x: F.coalesce(x.rlike("(?i)" + pattern), F.lit(False))), F.lit(False))


def all_of(values: Column, pattern: str) -> Column:
    """Whether all of an array's values have the pattern; all of an empty or missing one have."""
    return F.coalesce(F.forall(values, lambda x: F.coalesce(x.rlike("(?i)" + pattern), F.lit(False))), F.lit(True))


def supported(found: Column, sources: Column) -> Column:
    """A finding counts only with a source."""
    return F.coalesce(found, F.lit(False)) & (F.coalesce(F.size(sources), F.lit(0)) > 0)


def publication_key(c: Column) -> Column:
    """Publication number without dashes and kind code."""
    return F.regexp_replace(F.replace(c, F.lit("-"), F.lit("")), r"^([A-Z]{2}\d+).*", "$1")


def compact_date(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd")))


def slashed_date(c: Column) -> Column:
    """DD/MM/YYYY anywhere in the text."""
    found = F.regexp_extract(c, r"(\d{2}/\d{2}/\d{4})", 1)
    return F.to_date(F.try_to_timestamp(found, F.lit("dd/MM/yyyy")))


def claim_key(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the parts joined by ``|``; null is empty."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 1, 16)


def unescaped(c: Column) -> Column:
    for old, new in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_tags(c: Column) -> Column:
    return unescaped(F.regexp_replace(c, "<[^>]+>", " "))


def section_before(c: Column, marker: str) -> Column:
    return F.element_at(F.split(c, "(?i)" + marker, 2), 1)


def symbols(c: Column, stop: list[str] = (), low: int = 1, high: int = 6) -> Column:
    """Different upper-case tokens in order of appearance, less stop words."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(rf"\b([A-Z][A-Z0-9]{{{low},{high}}})\b"), 1))
    return F.array_except(found, F.array(*map(F.lit, stop))) if stop else found


def unsuppressed(c: Column, low: int = 1, high: int = 6) -> Column:
    """Symbols that are not followed by a status word (negative, mutant, high ...)."""
    after = r"(?!\s*[- ]\s*(?i:neg|pos|low|high|mut|wild|wt|amplif|alter|defic))"
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"\b([A-Z][A-Z0-9]{{{low},{high}}})\b{after}"), 1))


def whole_token(text: Column, form: Column) -> Column:
    """Whether ``form`` occurs in ``text`` as a whole token (per-row pattern)."""
    return F.rlike(text, F.concat(F.lit(r"(?<![A-Z0-9])\Q"), form, F.lit(r"\E(?![A-Z0-9])")))


def fingerprint(c: Column, rules: dict[str, tuple[str, int]]) -> tuple[Column, Column]:
    """Weighted sum of the patterns found, and their sorted names."""
    hit = {n: F.coalesce(c.rlike("(?i)" + p), F.lit(False)) for n, (p, _) in rules.items()}
    score = sum((F.when(hit[n], F.lit(w)).otherwise(0) for n, (_, w) in rules.items()), F.lit(0))
    return score, F.array_sort(F.filter(F.array(*[F.when(hit[n], F.lit(n)) for n in rules]), lambda x: x.isNotNull()))


def guarded(c: Column, strong: str, word: str, negation: str) -> Column:
    """Strong evidence, or the word without a negation."""
    return F.coalesce(c.rlike("(?i)" + strong) | (c.rlike("(?i)" + word) & ~c.rlike("(?i)" + negation)), F.lit(False))


def leads(c: Column, sep: str, keep: str, low: int = 12, high: int = 320, most: int = 3) -> Column:
    """The first parts that hold ``keep``, of a length between the bounds, and that are no numbered paragraph."""
    return F.slice(F.filter(F.split(c, sep), lambda x: x.contains(keep) & (F.length(x) > low) & (F.length(x) < high) & ~x.startswith("[")), 1, most)


def snippet(c: Column, pattern: str, n: int = 40) -> Column:
    return F.substring(F.regexp_extract(c, "(?i)" + pattern, 0), 1, n)


def independent_claims(c: Column) -> Column:
    """Numbered claims that do not refer back to another."""
    parts = F.transform(F.split(c, r"(?m)^\s*\d+\s*[.]\s+"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda x: (x != "") & ~x.rlike(r"(?i)\bclaims?\s+\d+"))


def number(c: Column) -> Column:
    """Number with thousands commas; anything else is null."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def positions_of(c: Column, letter: str, regions: list[tuple[str, int, int]]) -> Column:
    """``region@position`` for each place (from 1) of ``letter`` in a region."""
    if not regions:
        return F.array().cast("array<string>")

    def within(name: str, lo: int, hi: int) -> Column:
        hit = F.filter(F.sequence(F.lit(lo), F.lit(hi)), lambda i: F.substring(c, i, F.lit(1)) == letter)
        return F.transform(hit, lambda i: F.concat(F.lit(name + "@"), i.cast("string")))

    return F.concat(*(within(*r) for r in regions))


def smoothed_ratio(recent: Column, base: Column) -> Column:
    return (recent + 1).cast("double") / (base + 1)


def rescued_json(c: Column, schema: str) -> Column:
    """JSON from text that may have a fence or words around it: the outermost list or object, whichever the schema asks for."""
    pattern = r"(?s)(\[.*\])" if schema.strip().lower().startswith("array") else r"(?s)(\{.*\})"
    return F.from_json(F.regexp_extract(c, pattern, 1), schema)


def person_name(c: Column) -> Column:
    return c.rlike(r"^[A-Z][a-z]+ [A-Z][a-z]+$")


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal by the Abramowitz-Stegun polynomial 26.2.17 (error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    p = poly * F.exp(-a * a / 2) / 2.5066282746310002
    return F.when(z >= 0, p).otherwise(1 - p)
