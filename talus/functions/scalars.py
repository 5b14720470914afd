"""Scalar functions as Column expressions: all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import SUM_TOLERANCE

#: Token patterns.
BO = r"^[0-9]{16}$"
MONEY = r"^\(?-?[0-9][0-9,]*\.[0-9]+\)?$"
INTEGER = r"^[0-9][0-9,]*$"
NUMBER = r"^\(?-?[0-9][0-9,]*(\.[0-9]+)?\)?$"
YEAR = r"\b((?:19|20)[0-9]{2})(?:\s*[-–/]\s*((?:19|20)?[0-9]{2}))?\b"
TOTAL_LABEL = r"(?i)^\W*(grand\s+|sub\s*-?\s*)?total\b"
ADDRESS_WORDS = r"\b(FLOOR|HOUSE|ROAD|APT|FLAT|BUILDING|MANSION|TOWER|AVENUE)\b"
FILE_SUFFIX = r"(?i)\.(pdf|xlsx?|docx?|csv|jpe?g|png)(\?|#|$)"
LINK_WORDS = r"(?i)unclaim|unpaid|undistribut|unsettl|dividend|suspense|refund"

#: Words of names.
TITLES = ("MR", "MRS", "MS", "MISS", "DR", "PROF", "ALHAJ", "ALHAJJ", "HAJI", "HAJEE", "ENGR", "ADV", "LATE")
SYNONYMS = {
    "MD": "MOHAMMAD", "MOHD": "MOHAMMAD", "MOHAMMED": "MOHAMMAD", "MUHAMMAD": "MOHAMMAD", "MST": "MOSAMMAT", "MOST": "MOSAMMAT",
    "MOSAMMOT": "MOSAMMAT", "ABDL": "ABDUL", "UDDEEN": "UDDIN", "CHOUDHURY": "CHOWDHURY", "CHAUDHURY": "CHOWDHURY", "BEGAM": "BEGUM",
}
INSTITUTIONS = ("LTD", "LIMITED", "PLC", "BANK", "FUND", "TRUST", "SECURITIES", "INVESTMENT")
#: Ordered patterns of dividend types (on lower-cased text).
TYPE_PATTERNS = (("ipo_refund", "refund"), ("right", r"right\s*share|rights?\s*issue"), ("fraction", "fraction"), ("other", "subscription"))

_ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
_BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
#: Latin spellings of Bengali letters and signs; what is joined without a letter of its own is empty.
BENGALI = {
    "ঁ": "N", "ং": "N", "ঃ": "H", "অ": "a", "আ": "aa", "ই": "i", "ঈ": "ii", "উ": "u", "ঊ": "uu", "ঋ": "R", "ঌ": "RR", "এ": "e", "ঐ": "ai",
    "ও": "o", "ঔ": "au", "ক": "k", "খ": "kh", "গ": "g", "ঘ": "gh", "ঙ": "ng", "চ": "c", "ছ": "ch", "জ": "j", "ঝ": "jh", "ঞ": "ny", "ট": "tt",
    "ঠ": "tth", "ড": "dd", "ঢ": "ddh", "ণ": "nn", "ত": "t", "থ": "th", "দ": "d", "ধ": "dh", "ন": "n", "প": "p", "ফ": "ph", "ব": "b", "ভ": "bh",
    "ম": "m", "য": "y", "র": "r", "ল": "l", "শ": "sh", "ষ": "ss", "স": "s", "হ": "h", "\u09bc": "'", "া": "aa", "ি": "i", "ী": "ii", "ু": "u",
    "ূ": "uu", "ৃ": "R", "ৄ": "RR", "ে": "e", "ৈ": "ai", "ো": "o", "ৌ": "au", "্": "", "ৎ": "", "ৗ": "+", "\u09dc": "rr", "\u09dd": "rh",
    "\u09df": "yy", "০": "0", "১": "1", "২": "2", "৩": "3", "৪": "4", "৫": "5", "৬": "6", "৭": "7", "৮": "8", "৯": "9", "\u200c": "", "\u200d": "",
}


def fold_digits(c: Column) -> Column:
    """Bengali digits as ASCII digits."""
    return F.translate(c, _BENGALI_DIGITS, "0123456789")


def tokens(c: Column) -> Column:
    """Words between Unicode white space; an empty array for a null or blank text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda t: t != "")


def number(c: Column) -> Column:
    """A number token's value: commas dropped, parentheses stripped (they do not negate); null for what is no number."""
    plain = F.btrim(F.replace(c, F.lit(","), F.lit("")), F.lit("()"))
    return F.when(plain.rlike(r"^-?[0-9]+(\.[0-9]*)?$"), plain.try_cast("double"))


def year_start(c: Column) -> Column:
    """The first year 19dd or 20dd anywhere in the text; null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), "(?:19|20)[0-9]{2}", 0), F.lit("")).try_cast("int")


def year_span(c: Column) -> Column:
    """The first year or range of years, as printed; null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), YEAR, 0), F.lit(""))


def dividend_type(text: Column, default: Column | None = None) -> Column:
    """Type by ordered patterns. With a default, what no pattern decides keeps it; without, a cash word gives cash, else null."""
    s = F.lower(F.coalesce(text, F.lit("")))
    when = reduce(lambda w, p: w.when(s.rlike(p[1]), p[0]), TYPE_PATTERNS[1:], F.when(s.rlike(TYPE_PATTERNS[0][1]), TYPE_PATTERNS[0][0]))
    when = when.when(s.rlike("bonus|stock") & ~s.rlike("cash div"), "stock")
    return when.when(s.rlike("cash|dividend|unclaim|unpaid"), "cash") if default is None else when.otherwise(default)


def latin(c: Column) -> Column:
    """Bengali letters spelt in Latin ones; texts without them as they are."""
    spelt = F.create_map(*[F.lit(x) for pair in BENGALI.items() for x in pair])
    return F.when(c.rlike("[\u0980-\u09ff]"), F.array_join(F.transform(F.split(c, ""), lambda t: F.coalesce(F.try_element_at(spelt, t), t)), "")).otherwise(c)


def name_tokens(c: Column) -> Column:
    """Upper-case words of a name: Bengali in Latin letters, accents off, synonyms mapped, titles dropped (repeats stay)."""
    plain = F.upper(F.translate(latin(F.coalesce(c, F.lit(""))), _ACCENTED, _PLAIN))
    words = F.filter(F.split(F.regexp_replace(plain, "[^A-Z0-9 ]+", " "), " +"), lambda t: (t != "") & ~t.isin(*TITLES))
    same = F.create_map(*[F.lit(x) for pair in SYNONYMS.items() for x in pair])
    return F.transform(words, lambda t: F.coalesce(F.try_element_at(same, t), t))


def normal_name(c: Column) -> Column:
    return F.array_join(name_tokens(c), " ")


def is_institution(c: Column) -> Column:
    return F.arrays_overlap(name_tokens(c), F.array(*map(F.lit, INSTITUTIONS)))


def sorted_words(c: Column) -> Column:
    """Words in order, joined by spaces: the blocking key of names."""
    return F.array_join(F.array_sort(tokens(c)), " ")


def slug(c: Column, n: int = 60) -> Column:
    """Runs of other characters than word characters and hyphens become one underscore; at most n characters, `file` if nothing is left."""
    s = F.substring(F.btrim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\w-]+", "_"), F.lit("_")), 1, n)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("file"))


def no_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def folio_key(c: Column) -> Column:
    """Upper case without white space and hyphens."""
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s-]", ""))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def grouped_digits(c: Column) -> Column:
    """Digits in fours."""
    return F.regexp_replace(digits_only(c), "([0-9]{4})(?=[0-9])", "$1 ")


def lakh(c: Column, places: int = 2) -> Column:
    """A number with thousands, then hundreds grouped: 12,34,567.80."""
    text = F.format_string(f"%.{places}f", F.round(c, places))
    end = r"\." if places else "$"
    return F.regexp_replace(text, rf"([0-9])(?=([0-9]{{2}})*[0-9]{{3}}{end})", "$1,")


def label(c: Column, names: dict[str, str]) -> Column:
    """A name by map, the value itself without one."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, c), c)


def keyword(c: Column) -> Column:
    """A header word: punctuation off both ends, lower case."""
    return F.lower(F.btrim(c, F.lit("().:#,-_/*")))


def drive_id(url: Column) -> Column:
    """The file id of a share link; null without one."""
    of = lambda pattern: F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1), F.lit(""))
    return F.coalesce(of("/d/([A-Za-z0-9_-]{10,})"), of("[?&]id=([A-Za-z0-9_-]{10,})"))


def without_dots(url: Column) -> Column:
    """A url whose path has no `.` and `..` segments: `..` takes the segment before it away, if there is one."""
    head = F.regexp_extract(url, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    rest = F.regexp_extract(url, "^[^?#]*(.*)$", 1)
    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.concat(a, F.array(s))))
    end = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(head, F.lit("/"), F.array_join(kept, "/"), end, rest)).otherwise(url)


def joined_url(base: Column, link: Column) -> Column:
    """A link seen from its page: absolute, scheme-relative, from the host's root, a query, or from the page's folder; dot segments are folded
    in what is joined."""
    origin = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page.rlike(r"^[a-z][a-z0-9+.-]*://[^/]*/"), F.regexp_extract(page, "^(.*/)", 1)).otherwise(F.concat(page, F.lit("/")))
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([a-z][a-z0-9+.-]*:)", 1), link))
        .when(link.startswith("/"), without_dots(F.concat(origin, link)))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), link))
        .otherwise(without_dots(F.concat(folder, link)))
    )


#: A file's name in a disposition header, how a PDF begins, and suffixes by words of content types, the first that fits.
DISPOSITION_NAME = "filename\\*?=(?:UTF-8'')?\"?([^\";]+)"
PDF_MAGIC = b"%PDF"
SUFFIX_OF_TYPE = (("pdf", ".pdf"), ("spreadsheet", ".xlsx"), ("excel", ".xlsx"), ("word", ".docx"), ("jpeg", ".jpg"))


def sniffed_suffix(content: Column, content_type: Column, disposition: Column, url: Column) -> Column:
    """File suffix: that of the name in the disposition, by how the content begins, by its type, that of the url, `.bin` at last."""
    text = lambda c: F.lower(F.coalesce(c, F.lit("")))
    some = lambda c: F.nullif(c, F.lit(""))
    named = some(F.lower(F.regexp_extract(F.regexp_extract(F.coalesce(disposition, F.lit("")), DISPOSITION_NAME, 1), r"(\.[^.]*)$", 1)))
    by_type = [F.when(text(content_type).contains(word), suffix) for word, suffix in SUFFIX_OF_TYPE]
    by_url = some(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), FILE_SUFFIX, 1)))
    magic = F.when(F.substring(content, 1, len(PDF_MAGIC)) == F.lit(PDF_MAGIC), ".pdf")
    return F.coalesce(named, magic, *by_type, F.concat(F.lit("."), by_url), F.lit(".bin"))


def client_ip(headers_json: Column) -> Column:
    """First forwarded address of a JSON header object, `unknown` without one."""
    forwarded = F.get_json_object(headers_json, "$['x-forwarded-for']")
    return F.coalesce(F.nullif(F.split_part(F.coalesce(forwarded, F.lit("")), F.lit(","), F.lit(1)), F.lit("")), F.lit("unknown"))


def code_hash(code: Column) -> Column:
    return F.sha2(F.lower(F.btrim(code)), 256)


def tag_list(c: Column) -> Column:
    """Tags of a text joined by semicolons."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda t: t != "")


def with_tag(tags: Column, tag: str, when: Column) -> Column:
    """An array of tags with one more where the condition holds."""
    return F.when(when, F.array_append(tags, F.lit(tag))).otherwise(tags)


def has_tag(tags: Column, *names: str) -> Column:
    """Exact membership of any of the names."""
    return F.arrays_overlap(tags, F.array(*map(F.lit, names)))


def amount_triple(values: Column) -> Column:
    """Gross, tax, net among numbers in print order, by arithmetic within SUM_TOLERANCE; null without such numbers.

    The last three neighbours with gross - tax = net are taken first, then the last four with two deductions, then three
    numbers at most five places apart: the last net, its last tax, its last gross.
    """
    n = F.size(values)
    at = lambda i: F.get(values, i)
    struct = lambda g, t, m: F.struct(g.alias("gross"), t.alias("tax"), m.alias("net"))
    places = lambda last: F.when(last >= 0, F.sequence(last, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    near = lambda x: F.abs(x) <= SUM_TOLERANCE
    three = F.transform(F.filter(places(n - 3), lambda i: (at(i) > 0) & (at(i + 1) > 0) & (at(i + 2) > 0) & near(at(i) - at(i + 1) - at(i + 2))), lambda i: struct(at(i), at(i + 1), at(i + 2)))
    four = F.transform(
        F.filter(places(n - 4), lambda i: (at(i) > 0) & (at(i + 3) > 0) & (at(i + 1) >= 0) & (at(i + 2) >= 0) & (at(i + 1) + at(i + 2) > 0) & near(at(i) - at(i + 1) - at(i + 2) - at(i + 3))),
        lambda i: struct(at(i), at(i + 1) + at(i + 2), at(i + 3)),
    )
    apart = F.flatten(
        F.transform(
            places(n - 1),
            lambda k: F.flatten(
                F.transform(
                    F.filter(places(k - 1), lambda j: (j > 0) & (k - j < 5)),
                    lambda j: F.transform(
                        F.filter(places(j - 1), lambda i: (k - i <= 5) & (at(i) > 0) & (at(j) > 0) & (at(k) > 0) & near(at(i) - at(j) - at(k))),
                        lambda i: struct(at(i), at(j), at(k)),
                    ),
                )
            ),
        )
    )
    return F.coalesce(*(F.get(found, F.lit(0)) for found in (three, four, apart)))


def stamp(ts: Column) -> Column:
    """A time to the second, as manifests hold it."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
