"""Writings of postal addresses and street crossings that denote one place.

Every distinct value is parsed into a house number and a street, or two streets (direction, name, kind), apart from
unit, floor, remarks and locality. It is then expanded into all plausible normalised forms: each name as written, the
well-attested name that it is a slip of, or, where it is too rare to tell, every rare name within a slip or two (all found
by equality joins on shared deletion variants, never by comparing all names); the kind as written or, where it is
missing, every kind attested for that street. The component combinations are hashed, exploded and equi-joined on any
shared hash; pairs with conflicting house numbers, directions, kinds or localities are rejected.

Scale: work is on distinct values; parsing is one Arrow-batched pass without a shuffle. Deletion variants are drawn for
distinct names alone, as pairs of hashes; the attested side is broadcast only after a check of its size. A value is
exploded into its forms only, about one row each. Name and kind statistics are aggregations over all values and stay
distributed; the list of localities, rid of its slips, is collected, bounded by `max_localities` (more are an error, so
that none is left out silently). The self-join is on the form hash; a place's distinct writings meet there and nowhere else.

Defined cases: null, blank and unparsable values (no house number and no second street) denote no place; equal values
are one value; ties between equally near names go to the more frequent, then smaller name; unit and floor never
matter; values of any length are parsed whole; empty tables give an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from ..session import cut as keep
from ..session import small_enough

KINDS = {
    "street": ("street", "st", "str"), "avenue": ("avenue", "av", "ave", "aven"), "road": ("road", "rd"), "drive": ("drive", "dr", "drv"),
    "place": ("place", "pl"), "court": ("court", "ct", "crt"), "terrace": ("terrace", "ter", "terr"), "boulevard": ("boulevard", "blvd", "boul"),
    "lane": ("lane", "ln"), "square": ("square", "sq"), "alley": ("alley", "aly"), "plaza": ("plaza", "plz"), "parkway": ("parkway", "pkwy"),
    "highway": ("highway", "hwy"), "circle": ("circle", "cir"),
}
_KIND = {w: k for k, ws in KINDS.items() for w in ws}
_DIR = {"n": "n", "no": "n", "north": "n", "s": "s", "so": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w"}
_ORD = {w: str(i + 1) for i, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split())}
_UNIT = r"(?:apt|apartment|unit|suite|ste|store|shop|room|rm)\b\.?\s*(?:no\.?|#)?\s*\w{1,4}\b|#\s*\w{1,4}\b|\b(?:\d+(?:st|nd|rd|th)|first|second|third|fourth|fifth|ground|top|lower|upper)\s+(?:floor|fl)\b\.?|\bfl(?:oor)?\.?\s*\d+\b|\bbasement\b|\bbsmt\b"
_REMARK = r"\bmain entrance\b|\bstore\s?front\b|\brear\b\.?\s*\bbldg\b\.?|\bcorner bldg\b\.?|\brear\b(?: building)?|\(.*?\)"
_LEAD = re.compile(r"^(?:in front of|outside(?: of)?|near(?: to)?|opposite(?: to)?|opp|across from|behind|next to|at|by)\b\.?\s*")
_CROSS_LEAD = re.compile(r"^(?:the\s+)?(?:corner|junction|intersection|crossing|cor)\b\.?\s*(?:of\s+)?")
_SEP = re.compile(r"\s*(?:&|\+|@|\band\b|\bat\b|\bwith\b|,?\s*\bcor\b\.?(?:\s*of)?|\bcorner of\b|/)\s*")


def _digits(t: str) -> str:
    """A number token with letters read as digits where scanning confuses them; a last A-H stays a suffix."""
    if not t[0].isdigit() and not re.fullmatch(r"[loi]\d[\dlois-]*", t):
        return t
    if re.fullmatch(r"\d+(?:st|nd|rd|th)", t):
        return t
    m = re.fullmatch(r"([\dlois]+(?:-[\dlois]+)?)([a-h]?)", t)
    return m.group(1).translate(str.maketrans("lois", "1015")) + m.group(2) if m else t


def _near(a: str, b: str, most: int) -> bool:
    """Edit distance (with swaps of neighbours) of at most `most`."""
    if abs(len(a) - len(b)) > most:
        return False
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return False
        two, one = one, row
    return one[-1] <= most


def _kind(t: str) -> str | None:
    if t in _KIND:
        return _KIND[t]
    return next((k for k in ("street", "avenue", "terrace", "boulevard", "place", "court", "drive", "road", "lane") if len(t) >= len(k) - 1 and len(k) > 3 and t[0] == k[0] and _near(t, k, 1 if len(k) < 6 else 2)), None)


def _street(tokens: list[str]) -> tuple[str, str, str] | None:
    """(direction, name, kind) of the tokens of one street."""
    t = [x for x in tokens if x]
    d = kind = ""
    if len(t) > 1 and t[0] in _DIR:
        d, t = _DIR[t[0]], t[1:]
    elif len(t) > 2 and t[-1] in _DIR:
        d, t = _DIR[t[-1]], t[:-1]
    if len(t) > 1 and (k := _kind(t[-1])):
        kind, t = k, t[:-1]
        if not d and len(t) > 1 and t[-1] in _DIR:
            d, t = _DIR[t[-1]], t[:-1]
    if not t:
        return None
    name = "".join(t)
    m = re.fullmatch(r"([\dlo]+)(?:st|nd|rd|th)?", name)
    if m and any(c.isdigit() for c in name):
        name = m.group(1).translate(str.maketrans("lo", "10"))
    elif name in _ORD:
        name = _ORD[name]
    else:
        near = [v for w, v in _ORD.items() if len(name) > 4 and name[0] == w[0] and _near(name, w, 1)]
        name = near[0] if near else name.replace("0", "o").replace("1", "l").replace("5", "s").replace("rn", "m").replace("cl", "d")
    return d, name, kind


def _tokens(s: str) -> list[str]:
    """Words of a street, ordinals written apart ('10 th') joined; 'st' after a number is an ordinal only where a kind follows."""
    t = re.sub(r"[^\w\s-]", " ", s).split()
    out: list[str] = []
    for i, w in enumerate(t):
        apart = out and re.fullmatch(r"[\dlo]*\d[\dlo]*", out[-1]) and i
        if apart and (w in ("nd", "rd", "th") or w == "st" and any(_kind(x) for x in t[i + 1 :])):
            out[-1] += w
        else:
            out.append(w)
    return [_digits(w) for w in out]


#: The word alone between commas before a region code or postal code at the end of a value.
_TAIL = r",\s*(\p{L}{3,})\s*,\s*(?:[a-z]{2}|(?:[a-z]{2}\s+)?\d{5})[^\p{L}\p{N}_]*$"


@lru_cache(maxsize=4)
def _by_variant(localities: frozenset[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for c in sorted(localities):
        for v in variants(c):
            out.setdefault(v, []).append(c)
    return out


@lru_cache(maxsize=100_000)
def _close(w: str, localities: frozenset[str], most: int) -> str | None:
    """The first locality within so many slips, found by shared deletion variants."""
    index = _by_variant(localities)
    return next((c for c in sorted({c for v in variants(w) for c in index.get(v, ())}) if _near(w, c, most)), None)


def _unglue(w: str, localities: frozenset[str]) -> str:
    """A word that runs through a kind of street or a locality, cut around it."""
    cut = next((k for k in range(4, len(w) - 3) if w[k:] in localities), None)
    if cut:
        w = f"{w[:cut]} {w[cut:]}"
    return re.sub(r"(?<=[^\W\d_]{4})(street|avenue|road|place|court|terrace|boulevard)(?=\s|$)", r" \1", w)


def parse(value: str, localities: frozenset[str] = frozenset()) -> tuple[str, str, list[tuple[str, str, str]]] | None:
    """(locality, house number, streets): a house number with one street, or '' with two."""
    s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", unicodedata.normalize("NFKC", value))
    s = re.sub(r"[\"“”‘’*;\s]+", " ", s.lower()).strip()
    while len(s) > 1 and s[0] == "(" and s[-1] == ")":
        s = s[1:-1].strip()
    s = re.sub(r"(\d)(?=(?!(?:st|nd|rd|th|[lois]{2,3})\b)(?!(?:st|nd|rd|th)(?:street|ave|st\b|pl|rd\b))[^\W\d_]{2,})", r"\1 ", s)
    s = re.sub(r"(\d(?:st|nd|rd|th))(?=[^\W\d_]{2,})", r"\1 ", s)
    s = re.sub(r"(?<=\d)-(?=\s)|(?<=\.)-(?=\d)", " ", s)
    s = _LEAD.sub("", s)
    s = re.sub(_REMARK, " , ", s)
    s = re.sub(_UNIT, " , ", s)
    # what stands between words in place of spaces or commas; a slash between two streets stays
    s = re.sub(r"(?<=[^\W\d_])-(?=[^\W_])|(?<=\d)-(?=[^\W\d_])", " ", s)
    s = re.sub(r"(?<=[^\W_])\.(?=[^\W_])", " ", s).replace(".", " ")
    s = re.sub(r"\s-+(?:\s|$)", " , ", s)
    s = re.sub(r"\b[o0]{2}[\dloi]{3}\b", " , ", s)
    s = re.sub(r"\bqx\b", " , ", s)
    s = re.sub(r"\b[^\W\d_]{12,}\b", lambda m: _unglue(m.group(), localities), s)
    city = ""
    parts = []
    for p in re.split(r"\s*,\s*", s):
        p = p.strip(" -/")
        pieces = [x.strip() for x in p.split("/")]
        for x in pieces:
            w = re.sub(r"[^\w ]", "", x)
            if w and " " not in w and w in localities:
                city = city or w
            elif w and " " not in w and len(w) > 5 and not _kind(w) and not any(c.isdigit() for c in w) and (near := _close(w, localities, 2)) and (len(pieces) > 1 or p != s.strip(" ,-/")):
                city = city or near
            elif w:
                parts.append(x if len(pieces) < 2 or x is pieces[0] else "/ " + x)
    s = " , ".join(parts).replace(", /", "/")
    words = s.split()
    for at in (-1, 0):  # a locality without a comma
        if len(words) > 2 and not city:
            w = words[at]
            hit = w if w in localities else _close(w, localities, 1) if len(w) > 5 else None
            if hit and not _kind(w):
                city = hit
                del words[at]
    s = " ".join(words).strip(" ,")
    before = None
    while before != s:
        before, s = s, _LEAD.sub("", s).strip(" ,")
        s = re.sub(r"^no\s+(?=[\dlo]*\d[\w-]*(?:\s|$))(?!\d+(?:st|nd|rd|th)\b)(?!\d+ (?:th|st|nd|rd)\b)", "", s)
    crossing = bool(_CROSS_LEAD.match(s))
    s = _CROSS_LEAD.sub("", s)
    sides = [x.strip(" ,") for x in _SEP.split(s) if x.strip(" ,")]
    token = _tokens
    number = re.compile(r"\d+(?:-\d+)?[a-h]?")
    if len(sides) == 2 and not number.fullmatch((token(sides[0]) or [""])[0]) or crossing and len(sides) >= 2:
        both = [_street(token(x)) for x in sides[:2]]
        return (city, "", sorted(b for b in both if b)) if all(both) and both[0] != both[1] else None
    t = token(s.replace(" , ", " "))
    house = ""
    if len(t) > 1 and number.fullmatch(t[0]) and not (len(t) > 1 and _kind(t[1]) and len(t) == 2):
        house, t = t[0], t[1:]
    elif len(t) > 1 and number.fullmatch(t[-1]):
        house, t = t[-1], t[:-1]
    else:
        at = next((i for i, x in enumerate(t) if number.fullmatch(x) and i + 1 < len(t) and not _kind(t[i + 1])), None)
        if at is None:
            return None
        house, t = t[at], t[at + 1 :] if at + 1 < len(t) else t[:at]
    street = _street(t)
    return (city, house.lstrip("0") or "0", [street]) if street else None


def variants(name: str) -> list[str]:
    """The name and its deletions: one character, two in longer names. Names within as many slips share one.

    Of names beyond 40 characters, of which two slips leave one end with at most one, the ends stand for the whole.
    """
    less = lambda w: {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}
    if name[0].isdigit() or len(name) < 4:
        return [name]
    if len(name) > 40:
        return sorted({"<" + v for v in less(name[:20])} | {">" + v for v in less(name[-20:])})
    one = less(name)
    return sorted(one if len(name) < 7 else {x for v in one for x in less(v)})


@F.pandas_udf(ArrayType(StringType()))
def _two_deletions(s: pd.Series) -> pd.Series:
    """The word without up to two characters; words within two slips share one. From 39 characters on the ends serve, as in `variants`."""
    less = lambda w: {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}

    def of(w: str) -> list[str]:
        whole = {x for v in less(w) for x in less(v)} if len(w) <= 40 else set()
        ends = {"<" + v for v in less(w[:20])} | {">" + v for v in less(w[-20:])} if len(w) >= 39 else set()
        return sorted(whole | ends)

    return s.map(of)


@F.pandas_udf(BooleanType())
def _within_two(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_near(x, y, 2) for x, y in zip(a, b)], dtype=bool)


@F.pandas_udf(BooleanType())
def _no_locality(s: pd.Series) -> pd.Series:
    return s.map(lambda w: bool(_kind(w)) or w in _DIR or w in ("floor", "bldg", "front", "entrance", "storefront")).astype(bool)


def _without_slips(words: DataFrame) -> DataFrame:
    """The words of (w, n), n > 1, that are no slip of a kept word at least eight times as frequent. Decided in rounds from the most frequent downwards, as a slip of a slip stays."""
    v = words.select("w", "n", F.explode(_two_deletions("w")).alias("v")).select("w", "n", F.xxhash64("v").alias("v"))
    often = v.filter("n >= 16").select(F.col("w").alias("to"), F.col("n").alias("m"), "v")
    slips = keep(v.join(often, "v").filter("m >= 8 * n").select("w", "to").distinct().filter(_within_two("w", "to")))
    kept = keep(words.select("w").join(slips, "w", "left_anti"))
    while not slips.isEmpty():
        gone = slips.join(kept.withColumnRenamed("w", "to"), "to", "left_semi").select("w").distinct()
        open_ = keep(slips.join(gone, "w", "left_anti"))
        slips = keep(open_.join(gone.withColumnRenamed("w", "to"), "to", "left_anti"))
        kept = keep(kept.unionByName(open_.select("w").distinct().join(slips, "w", "left_anti")))
    return kept


def localities(values: DataFrame, max_localities: int = 5_000) -> frozenset[str]:
    """Words that stand between the street and the region of two values or more, without slips of much more frequent ones. More than `max_localities` words are an error.

    Slips grow with the table and are many times the localities, so they are dropped before anything is collected.
    """
    words = values.select(F.regexp_extract(F.lower("value"), _TAIL, 1).alias("w")).filter("w <> ''")
    n = keep(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").filter(~_no_locality("w")))
    rows = _without_slips(n).limit(max_localities + 1).collect()
    if len(rows) > max_localities:
        raise ValueError(f"more than max_localities = {max_localities} localities; none is left out silently")
    return frozenset(r["w"] for r in rows)


def parsed(values: DataFrame, known: frozenset[str]) -> DataFrame:
    """(value, city, house, streets) of every distinct value that denotes a place."""
    shared = values.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(v, *p) for v in b["value"] if v and (p := parse(v, shared.value))]
            yield pd.DataFrame([(v, c, h, [dict(zip("dnk", s)) for s in ss]) for v, c, h, ss in rows], columns=["value", "city", "house", "streets"])

    return values.mapInPandas(run, "value string, city string, house string, streets array<struct<d:string,n:string,k:string>>")


@F.pandas_udf(ArrayType(StringType()))
def _spellings(s: pd.Series) -> pd.Series:
    return s.map(variants)


@F.pandas_udf(BooleanType())
def _slip(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_near(x, y, 1 if min(len(x), len(y)) < 7 else 2) for x, y in zip(a, b)], dtype=bool)


def _variants(names: DataFrame) -> DataFrame:
    """(name, n, v): a hash of every deletion variant of every name."""
    return names.select("name", "n", F.explode(_spellings("name")).alias("v")).select("name", "n", F.xxhash64("v").alias("v"))


def corrections(names: DataFrame, ratio: float = 2.0, most: int = 20_000) -> DataFrame:
    """(name, to) for (name, n): well-attested names within a slip or two, at least `ratio` times as frequent.

    The attested names are broadcast where there are at most `most` of them.
    """
    attested = names.filter("n > 2")
    side = _variants(attested).select(F.col("name").alias("to"), F.col("n").alias("m"), "v")
    pairs = _variants(names).join(F.broadcast(side) if small_enough(attested, most) else side, "v").filter((F.col("m") >= ratio * F.col("n")) & (F.col("name") != F.col("to")))
    pairs = pairs.select("name", "to", "m").distinct().filter(_slip("name", "to"))
    return pairs.groupBy("name").agg(F.min_by("to", F.struct(F.levenshtein("name", "to"), -F.col("m"), "to")).alias("to"))


def alternatives(names: DataFrame, rare: int = 8) -> DataFrame:
    """(name, alt) for (name, n): of each two names within a slip or two that stand in at most `rare` values, the smaller as an alternative of the larger."""
    v = _variants(names.filter(F.col("n") <= rare))
    pairs = v.select("name", "v").join(v.select(F.col("name").alias("alt"), "v"), "v").filter("name > alt").select("name", "alt").distinct()
    return pairs.filter(_slip("name", "alt"))


def same_place(values: DataFrame, attested: int = 3) -> DataFrame:
    """(address_a, address_b), a < b, of distinct values (column `value`) that denote one place."""
    values = keep(values.select("value").filter("length(trim(value)) > 0").distinct())
    p = keep(parsed(values, localities(values)))
    side = p.select("value", "city", "house", F.posexplode("streets").alias("side", "s")).select("value", "city", "house", "side", "s.d", "s.n", "s.k")
    count = lambda df: keep(df.groupBy(F.col("n").alias("name")).agg(F.countDistinct("value").alias("n")))
    fixes = corrections(count(side))
    # one step further where a correction was itself corrected
    fixes = keep(fixes.alias("x").join(fixes.alias("y"), F.col("x.to") == F.col("y.name"), "left").select("x.name", F.coalesce("y.to", "x.to").alias("to")))
    side = keep(side.join(fixes, side["n"] == fixes["name"], "left").withColumn("n", F.coalesce("to", "n")).drop("name", "to"))
    kinds = side.filter("k <> ''").groupBy("d", "n", "k").agg(F.count(F.lit(1)).alias("c"))
    kinds = kinds.groupBy("d", "n").agg(F.collect_list(F.struct("c", "k")).alias("ks")).select("d", "n", F.expr(f"transform(filter(ks, x -> x.c >= {attested} OR x.c >= array_max(ks).c), x -> x.k)").alias("ks"))
    others = alternatives(count(side)).groupBy(F.col("name").alias("n")).agg(F.collect_set("alt").alias("alts"))
    side = side.join(kinds, ["d", "n"], "left").join(others, "n", "left").withColumn("forms", F.when(F.col("k") != "", F.array("k")).otherwise(F.coalesce("ks", F.array(F.lit("")))))
    side = side.withColumn("forms", F.expr("flatten(transform(array_append(coalesce(alts, array()), n), x -> transform(forms, f -> concat_ws('|', d, x, f))))"))
    whole = side.groupBy("value", "city", "house").agg(F.sort_array(F.collect_list(F.struct("n", "side", "forms"))).alias("s"))
    one = whole.filter("size(s) = 1").withColumn("h", F.explode(F.expr("transform(s[0].forms, f -> xxhash64('building', house, f))")))
    two = whole.filter("size(s) = 2").withColumn("h", F.explode(F.expr("flatten(transform(s[0].forms, f -> transform(s[1].forms, g -> xxhash64('crossing', least(f, g), greatest(f, g)))))")))
    exploded = keep(one.unionByName(two).select("value", "city", "house", F.expr("transform(s, x -> x.n)").alias("names"), "h").distinct())
    a, b = exploded.alias("a"), exploded.alias("b")
    alike = F.expr("forall(zip_with(a.names, b.names, (x, y) -> levenshtein(x, y) <= 3), x -> x) OR size(a.names) = 2 AND levenshtein(a.names[0], b.names[1]) <= 3 AND levenshtein(a.names[1], b.names[0]) <= 3")
    return (
        a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.value") < F.col("b.value")))
        .filter("a.house = b.house AND (a.city = b.city OR a.city = '' OR b.city = '')")
        .filter(alike)
        .select(F.col("a.value").alias("address_a"), F.col("b.value").alias("address_b"))
        .distinct()
    )
