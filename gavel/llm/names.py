"""Variant spellings of persons and organisations.

Distinct values are parsed into persons (given name, surname) or organisations (family or place names, line of business
or purpose; which words are purposes is learned from the endings that many different names share). Titles, remarks, legal forms, order and case fall away. Parsed forms are blocked by phonetic codes of
their sorted tokens (vowels dropped, consonants in six classes; the whole code, the code less any one consonant, and its
first and last four each make a block, so a slip in any place leaves a common one), compared inside a block by Jaro-Winkler similarity and a nickname table, and accepted pairs
are clustered by connected components. Initials, nicknames of several names and bare surnames join a cluster only
afterwards and only where one candidate clearly stands out, so that they never weld two persons together.

Scale: all comparisons are between distinct parsed forms; equal forms never meet in pairs until the output, which by
its definition holds the pairs of a cluster. Blocks are equality joins with a built-in edit distance before the Python
comparison. The dictionary of given names is an aggregation over all values, bounded by `max_given` entries when
collected; more are an error, so that none is left out silently.

Defined cases: null and blank values are no cases; values that name no organisation ('Resident', 'Self') are dropped by
a list; values that are trade names elsewhere are dropped by an anti-join; equal values are one value; ties between
candidates leave a short form alone; very long values are parsed whole and compared only inside their block; empty
tables give an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut

#: Short and foreign forms of given names; a short form may stand for several.
NICKNAMES = {
    "robert": "bob bobby rob robbie", "richard": "rick dick rich ricky richie", "william": "bill billy will willie liam", "edward": "ed eddie ted ned teddy", "theodore": "ted teddy theo",
    "elizabeth": "liz beth betty lizzie eliza betsy libby lisa", "eleanor": "ellie nell nora ella", "katherine": "kate kathy katie kat kitty kay", "margaret": "peggy meg maggie marge greta",
    "patricia": "pat patty trish tricia", "barbara": "barb babs basia", "malgorzata": "gosia malgosia", "aleksander": "alex olek sasza", "alexander": "alex sasha", "alexandra": "alex sandra",
    "guadalupe": "lupe lupita", "francisco": "pancho paco frank", "ignacio": "nacho", "jose": "pepe", "josefina": "josie fina pepita pepa", "beatriz": "bea betty trixie", "virginia": "ginny ginger",
    "charles": "charlie chuck chas", "frederick": "fred freddy freddie", "henry": "hank harry hal", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey", "jerzy": "jurek jurek",
    "stanislaw": "staszek stan stas", "kasimir": "kazik kaz", "thomas": "tom tommy", "tobias": "toby", "susan": "sue susie suzie", "dorothy": "dot dottie dolly", "deborah": "deb debbie",
    "anthony": "tony", "antonio": "tony tonio", "albert": "al bert bertie", "andrew": "andy drew", "michael": "mike mick mickey", "daniel": "dan danny", "david": "dave davey", "donald": "don donny",
    "gregory": "greg", "jennifer": "jen jenny", "jessica": "jess jessie", "judith": "judy jude", "kenneth": "ken kenny", "lawrence": "larry lars", "leonard": "len lenny", "leopold": "leo poldi", "matthew": "matt",
    "nathaniel": "nate nat", "nicholas": "nick nicky", "pamela": "pam", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "ronald": "ron ronny", "samuel": "sam sammy",
    "sandra": "sandy", "stephen": "steve", "steven": "steve", "timothy": "tim", "victoria": "vicky", "walter": "walt wally", "zachary": "zach zack", "benjamin": "ben benny", "gerald": "gerry jerry",
    "jerome": "jerry", "abigail": "abby gail", "amanda": "mandy", "christopher": "chris kit", "christina": "chris tina", "cynthia": "cindy", "dolores": "lola", "eugene": "gene", "florence": "flo flossie",
    "frances": "fran fanny", "isabel": "bella izzy", "jacqueline": "jackie", "magdalena": "magda lena", "mateo": "teo", "nadia": "nadzia", "teresa": "terry tess", "valeria": "val", "vincent": "vince vinnie",
    "wojciech": "wojtek", "katarzyna": "kasia", "joanna": "asia", "agnieszka": "aga", "zofia": "zosia", "maria": "marysia", "luis": "lucho", "eduardo": "lalo", "enrique": "quique", "jesus": "chuy", "rosario": "chayo",
    "concepcion": "concha", "manuel": "manolo", "rafael": "rafa", "silvestre": "chive", "yvonne": "evie vonnie", "ursula": "ulla", "calvin": "cal", "gilbert": "gil bert", "bartholomew": "bart", "wanda": "wandzia",
}
_FORMAL: dict[str, tuple[str, ...]] = {}
for _f, _ns in NICKNAMES.items():
    for _n in (_f, *_ns.split()):
        _FORMAL[_n] = tuple(dict.fromkeys((*_FORMAL.get(_n, ()), _f)))
#: Abbreviations whose letters do not stand in the full word in that order.
_SHORT = {"centre": "center", "lnge": "lounge", "tav": "tavern", "bros": "brothers", "grp": "group", "svcs": "services", "svc": "services", "mgmt": "management", "mgt": "management", "bev": "beverage", "hsg": "housing", "blk": "block"}
_LEGAL = r"(?:l\s*l\s*c|inc|incorporated|corp|corporation|ltd|limited(?:\s+liability\s+co(?:mpany)?)?|co|l\s*l\s*p)"
NO_ORGANISATION = r"(?i)^\W*((the |a |an |local |area |long[- ]?time |nearby |concerned |private )*(resident|neighbou?r|homeowner|tenant|citizen|member of the public|individual|parent|visitor|shop ?owner|business owner|property owner|worker|student|public)s?|self|n/?a|none|no affiliation|unaffiliated|unknown|private|not given|not stated|independent|himself|herself|themselves|-+|tbd)\W*$"
_TITLE = re.compile(r"^(?:(?:mr|mrs|ms|mx|dr|hon|rev|sen|prof|councilmember|council member|miss|sir)\b\.?,?\s+)+")
_REMARK = re.compile(r"\((?:via|on|by) [^)]*\)|\bvia zoom\b|[,\s]+(?:esq|phd|ph d|md|jr|sr|iii|ii|cpa|aia)\b\.?(?=\s*(?:,|\(|$))")
_FORMED = re.compile(r"^.{0,30}?\b(?:to be formed(?: by)?|tbf(?: by)?|t/b/f(?: by)?|formed by)\b[:\s]*")
_OCR = (("0", "o"), ("1", "l"), ("5", "s"), ("rn", "m"), ("cl", "d"))


def _clean(v: str) -> str:
    s = unicodedata.normalize("NFKD", re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", unicodedata.normalize("NFKC", v)))
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    return re.sub(r"\s+", " ", re.sub(r"[\"“”*‘]", " ", s)).strip()


def _fold(w: str) -> str:
    for a, b in _OCR:
        w = w.replace(a, b)
    return w


def near(a: str, b: str) -> bool:
    """Jaro-Winkler of 0.84 and as few edits as the length allows."""
    return a == b or jaro_winkler(a, b) >= 0.84 and _edits(a, b, 1 if min(len(a), len(b)) < 5 else 2 if min(len(a), len(b)) < 8 else 3)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    hit_b = [False] * len(b)
    found = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit_b[j] and b[j] == x:
                hit_b[j] = True
                found.append(x)
                break
    m = len(found)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(found, (c for c, h in zip(b, hit_b) if h))) / 2
    j = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    lead = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return j + lead * 0.1 * (1 - j)


def _edits(a: str, b: str, most: int) -> bool:
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


_CLASS = {**dict.fromkeys("bfpvw", "1"), **dict.fromkeys("cgjkqsxz", "2"), **dict.fromkeys("dt", "3"), "l": "4", **dict.fromkeys("mn", "5"), "r": "6"}


def phonetic(w: str) -> str:
    """Consonant classes in order, doubled letters and vowels dropped."""
    out = last = ""
    for c in w:
        k = _CLASS.get(c, "")
        if k and k != last:
            out += k
        last = k if k or c in "hw" else ""
    return out or "0"


def _stands_for(w: str, full: str) -> bool:
    """Whether a word is a word of a purpose, mistyped or cut short."""
    w = _SHORT.get(w, w)
    if w == full or len(full) > 3 and len(w) > 3 and _edits(w, full, 1 if len(full) < 6 else 2):
        return True
    if not 2 <= len(w) < len(full) or w[0] != full[0]:
        return False
    it = iter(full)
    return full.startswith(w) or len(w) >= 3 and w != full and all(c in it for c in w)


def _unglue(words: list[str], purposes: list[str]) -> list[str]:
    """Words that ran into a word of a purpose, cut before or after it where the rest of the purpose follows."""
    out: list[str] = []
    for i, w in enumerate(words):
        for p in purposes:
            full = p.split()
            hit = next((k for k, f in enumerate(full) if len(f) > 3 and w.endswith(f) and len(w) >= len(f) + 3 and words[i + 1 : i + len(full) - k] == full[k + 1 :]), None)
            if hit is not None:
                head = w[: -len(full[hit])]
                out += [head, full[hit]]
                break
        else:
            out.append(w)
    return out


def organisation(s: str, purposes: list[str]) -> tuple[str, list[str]] | None:
    """(purpose, names) of a cleaned value, or None where no purpose shows."""
    s = re.sub(r"\([^)]{1,6}\)", " ", s).replace("-", " ")
    s = re.sub(r"\bf\s*&\s*b\b", "food beverage", re.sub(r"\bbrewing co\b", "brewing company", " " + s.replace(".", " ")))
    s = re.sub(rf"[\s,]+{_LEGAL}\W*$", " ", s)
    s = re.sub(r"['’]s?\b", "", s)
    s = re.sub(r"\s*(?:&|\+|/|\band\b)\s*", " & ", s)
    s = re.sub(r"(\bfood)\s*\W*\s*&\W*\s*(?=b\w+)", r"\1 ", s)
    t = [w for w in re.sub(r"[^\w&, ]", " ", s).replace(",", " , ").split()]
    while t and t[0] in ("the", ","):
        t = t[1:]
    while t and t[-1] in (",", "the"):
        t = t[:-1]
    words = [w for w in t if w != ","]
    parts = {f for p in purposes for f in p.split() if len(f) > 5}
    for at in range(len(words) - 2, -1, -1):  # a word of a purpose with a space in it, or grown onto a legal form
        if words[at] + words[at + 1] in parts:
            words[at : at + 2] = [words[at] + words[at + 1]]
    if words and (m := re.fullmatch(r"(\w{4,})(?:inc|llc|ltd|corp)", words[-1])) and any(_stands_for(m.group(1), f) for p in purposes for f in p.split()):
        words[-1] = m.group(1)
    words = _unglue(words, purposes)
    best = None
    for p in purposes:
        full = p.split()
        n = len(full)
        for at in range(len(words) - n + 1):
            part = [_fold(w) if any(c.isdigit() for c in w) else w for w in words[at : at + n]]
            if not all(_stands_for(w, f) or _stands_for(_fold(w), _fold(f)) for w, f in zip(part, full)):
                continue
            rest = words[:at] + words[at + n :]
            rest = rest[1:] if rest[:1] == ["of"] else rest
            exact = sum(w == f for w, f in zip(part, full)) + n
            if rest and (best is None or exact > best[0]):
                best = (exact, p, rest)
        short = "".join(w[0] for w in full)
        if best is None and len(short) > 1 and len(words) > 1 and short in (words[-1], words[0]):
            best = (0, p, words[:-1] if words[-1] == short else words[1:])
    if best is None:
        return None
    rest = [w for w in best[2] if w not in ("of", "the")]
    names, now = [], ""
    for w in [*rest, "&"]:
        if w == "&":
            if now:
                names.append(_fold(now))
            now = ""
        else:
            now += w
    return (best[1], sorted(names)) if names else None


def person(s: str, given: frozenset[str]) -> tuple[str, str] | None:
    """(given name or initial, surname) of a cleaned value; the given name may be ''."""
    s = _FORMED.sub("", s)
    before = None
    while before != s:
        before, s = s, _REMARK.sub(" ", s)
        s = _TITLE.sub("", s.strip(" ,.;-()"))
    left, comma, right = s.partition(",")
    word = lambda x: [w for w in re.sub(r"[^\w ]", " ", re.sub(r"['’]", "", x)).split() if not w.isdigit() or w in "015"]
    a, b = word(left), word(right)
    a, b = [_fold(w) if len(w) > 1 else w for w in a], [_fold(w) if len(w) > 1 else w for w in b]
    known = lambda w: w in given or w in _FORMAL
    if comma and a and b:
        first = [w for w in b if len(w) > 1]
        return ("".join(first) if len(first) < 2 or known("".join(first)) else first[0]) if first else b[0], "".join(w for w in a if len(w) > 1) or "".join(a)
    t = a or b
    if not t:
        return None
    if len(t) == 1:
        return "", t[0]
    if len(t[0]) == 1 and len(t) > 1:
        rest = [w for w in t[1:] if len(w) > 1]
        return t[0], "".join(rest) or t[-1]
    if len(t[-1]) == 1:  # surname first: with an initial, or given name and middle initial
        whole = [w for w in t[:-1] if len(w) > 1]
        if len(whole) > 1 and not known(whole[0]) and (known(whole[-1]) or _like(whole[-1], given) and not _like(whole[0], given)):
            return whole[-1], "".join(whole[:-1])
        return (next(w for w in t[1:] if len(w) == 1), "".join(whole)) if len(whole) == 1 else (whole[0], "".join(whole[1:]))
    w = [x for x in t if len(x) > 1]
    if len(w) == 1:
        return t[0], w[0]
    if len(w) > 2 and known(w[0] + w[1]) and not known(w[0]):
        return w[0] + w[1], "".join(w[2:])
    if len(w) > 2 and known(w[-2] + w[-1]) and not known(w[-1]) and not known(w[0]):
        return w[-2] + w[-1], "".join(w[:-2])
    if known(w[-1]) and not known(w[0]):
        return w[-1], "".join(w[:-1])
    if not known(w[0]) and _like(w[-1], given) and not _like(w[0], given):
        return w[-1], "".join(w[:-1])
    return w[0], "".join(w[1:])


def _like(w: str, given: frozenset[str]) -> bool:
    """Whether a given name comes out by leaving out, doubling, swapping or replacing one character."""
    n = len(w)
    if n < 4:
        return False
    abc = "abcdefghijklmnopqrstuvwxyz"
    tries = (w[:i] + c + w[i + k :] for i in range(n + 1) for k in (0, 1) for c in ("", *abc))
    return any(x in given for x in tries) or any(w[:i] + w[i + 1] + w[i] + w[i + 2 :] in given for i in range(n - 1))


def given_names(values: DataFrame, max_given: int = 50_000) -> frozenset[str]:
    """Words that open a name, or follow the comma of one, more often than they end it; over all distinct values. More than `max_given` are an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for v in b["value"]:
                s = _TITLE.sub("", _REMARK.sub(" ", _clean(v)))
                left, comma, right = s.partition(",")
                w = [_fold(x) for x in re.sub(r"[^\w ]", " ", f"{right} {left}" if comma else s).split() if len(x) > 2]
                if len(w) == 2:
                    rows += [(w[0], 1), (w[1], -1)]
            yield pd.DataFrame(rows, columns=["w", "n"])

    n = values.filter("value IS NOT NULL").mapInPandas(run, "w string, n int").groupBy("w").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"))
    rows = n.filter("n > 0 AND c > 1").select("w").limit(max_given + 1).collect()
    if len(rows) > max_given:
        raise ValueError(f"more than max_given = {max_given} given names; none is left out silently")
    return frozenset(r["w"] for r in rows)


def _bare_words(s: str) -> list[str]:
    """The words of a cleaned value without what stands in brackets, legal form, possessives and joining words."""
    s = re.sub(r"\([^)]*\)", " ", s).replace("-", " ").replace(".", " ")
    s = re.sub(rf"[\s,]+{_LEGAL}\W*$", " ", s)
    return [w for w in re.sub(r"[^\w ]", " ", re.sub(r"['’]s?\b", "", s)).split() if w not in ("the", "and", "of")]


def _alike(a: str, b: str) -> bool:
    """Whether an ending is another one with words mistyped, cut short, or written together."""
    x, y = a.split(), b.split()
    return "".join(x) == "".join(y) or len(x) == len(y) and all(_stands_for(u, v) for u, v in zip(x, y))


def purposes_of(values: DataFrame, field_kinds: dict[str, str], given: frozenset[str], share: float = 0.003, support: int = 5) -> dict[str, list[str]]:
    """For organisations and applicants, the purposes and lines of business that the values themselves show.

    A purpose is an ending of one to three words that stands behind at least `support` different beginnings, and behind
    `share` of all different beginnings, so there are at most 3 / share of them whatever the number of values. Where the
    longer endings of one cover half of its beginnings they are taken in its place. Given names are no beginnings.
    """
    roles = {f: k for f, k in field_kinds.items() if k in ("organisation", "applicant")}
    shared = values.sparkSession.sparkContext.broadcast(given)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for b in batches:
            rows = []
            for f, v in zip(b["field"], b["value"]):
                s = _clean(v)
                if roles[f] == "applicant" and (_FORMED.match(s) or "," in re.sub(rf",\s*{_LEGAL}\W*$", "", s)):
                    continue
                w = _bare_words(re.sub(r"\bf\s*&\s*b\b", "food beverage", _TITLE.sub("", _REMARK.sub(" ", s))))
                if roles[f] == "applicant" and all(len(x) == 1 or x in known or x in _FORMAL or _like(x, known) for x in w[:-1]):
                    continue
                rows += [(roles[f], " ".join(w[-n:]), " ".join(w[:-n])) for n in (1, 2, 3) if len(w) > n]
            yield pd.DataFrame(rows, columns=["role", "ending", "head"])

    ends = values.filter(F.col("field").isin(list(roles))).select("field", "value").mapInPandas(run, "role string, ending string, head string")
    n = ends.groupBy("role", "ending").agg(F.countDistinct("head").alias("n"))
    all_ = ends.groupBy("role").agg(F.countDistinct("head").alias("all"))
    rows = n.filter(F.col("n") >= support).join(all_, "role").filter(F.col("n") >= share * F.col("all")).select("role", "ending", "n").collect()
    out: dict[str, list[str]] = {k: [] for k in ("organisation", "applicant")}
    for k in out:
        have = {r["ending"]: r["n"] for r in rows if r["role"] == k}
        covered = dict.fromkeys(have, 0)
        for e, c in have.items():
            rest = e.partition(" ")[2]
            if rest in have and 20 * c >= have[rest]:
                covered[rest] += c
        kept: list[str] = []
        for e in sorted(have, key=lambda e: (-have[e], e)):
            rest = e.partition(" ")[2]
            whole = 2 * covered[e] < have[e] and (rest not in have or 20 * have[e] >= have[rest] and 2 * covered[rest] >= have[rest])
            # an ending that writes a more frequent one shorter or mistyped is none of its own
            if whole and all(len(w) > 2 for w in e.split()) and not any(_alike(e, x) for x in kept):
                kept.append(e)
        out[k] = sorted(kept)
    return out


def forms(values: DataFrame, field_kinds: dict[str, str], given: frozenset[str], purposes: list[str], lines: list[str]) -> DataFrame:
    """(field, value, what, kind, names, first, legal): what is 'person', 'org' or 'other'. field_kinds: field -> person, organisation or applicant."""
    shared = values.sparkSession.sparkContext.broadcast((given, purposes, lines))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given, purposes, lines = shared.value
        for b in batches:
            rows = []
            for f, v in zip(b["field"], b["value"]):
                s, role = _clean(v), field_kinds[f]
                formed = role == "applicant" and bool(_FORMED.match(s))
                org = None if role == "person" or formed else organisation(s, purposes if role == "organisation" else lines)
                legal = bool(re.search(rf"[\s,.]{_LEGAL}\W*$", s))
                if org:
                    rows.append((f, v, "org", org[0], org[1], "", legal))
                elif role == "organisation" or legal and not formed:
                    t = sorted(_fold(w) for w in re.sub(r"[^\w ]", " ", re.sub(rf"[\s,]+{_LEGAL}\W*$", "", s)).split() if w not in ("the", "of", "and"))
                    rows.append((f, v, "other", "", ["".join(t)] if t else [], "", legal))
                elif p := person(s, given):
                    rows.append((f, v, "person", "", [p[1]], p[0], False))
            yield pd.DataFrame([r for r in rows if r[4]], columns=["field", "value", "what", "kind", "names", "first", "legal"])

    return values.mapInPandas(run, "field string, value string, what string, kind string, names array<string>, first string, legal boolean")


def _standing(f: str) -> tuple[str, ...]:
    return _FORMAL.get(f, (f,))


def _same_first(a: str, b: str) -> bool:
    """Given names of one person, as full names: equal, mistyped, or with one formal name each that is the same."""
    if a == b:
        return True
    fa, fb = _standing(a), _standing(b)
    if len(fa) == 1 and len(fb) == 1:
        return fa == fb or fa[0] == a and fb[0] == b and near(a, b) or near(a, b) and (a not in _FORMAL or b not in _FORMAL)
    return False


def _codes(names: list[str]) -> list[str]:
    """The codes of the sorted names, whole, with one consonant left out, and their first and last four."""
    c = "|".join(phonetic(n) for n in names)
    parts = c.split("|")
    return sorted({c, *(c[:i] + c[i + 1 :] for i in range(len(c)) if c[i] != "|"), "a" + "|".join(x[:4] for x in parts), "z" + "|".join(x[-4:] for x in parts)})


def variants(values: DataFrame, field_kinds: dict[str, str], trade_names: DataFrame | None = None, purposes: list[str] | None = None, lines: list[str] | None = None, dominance: float = 0.6) -> DataFrame:
    """(field, name_a, name_b), a < b, for (field, value, n): pairs of values of one entity.

    purposes, lines: of organisations and applicants; where they are not given the values teach them (`purposes_of`).
    trade_names: (value, n), values that are no applicants where they are written at least as often as trade names.
    dominance: share of the rows that one candidate must have for a short form to join it.
    """
    distinct = values.filter("length(trim(value)) > 0").groupBy("field", "value").agg(F.sum("n").alias("n"))
    orgs = [f for f, k in field_kinds.items() if k == "organisation"]
    distinct = cut(distinct.filter(~(F.col("field").isin(orgs) & F.col("value").rlike(NO_ORGANISATION))))
    people = distinct.filter(F.col("field").isin([f for f, k in field_kinds.items() if k == "person"]))
    given = given_names(people)
    if purposes is None or lines is None:
        learned = purposes_of(distinct, field_kinds, given)
        purposes = learned["organisation"] if purposes is None else purposes
        lines = learned["applicant"] if lines is None else lines
    parsed = forms(distinct.select("field", "value"), field_kinds, given, purposes, lines).join(distinct, ["field", "value"])
    if trade_names is not None:
        bare = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
        t = trade_names.groupBy(bare(F.col("value")).alias("bare")).agg(F.sum("n").alias("tn"))
        apps = [f for f, k in field_kinds.items() if k == "applicant"]
        mine = parsed.filter(F.col("field").isin(apps) & ~F.col("legal")).withColumn("bare", bare(F.col("value")))
        wrong = mine.groupBy("field", "bare").agg(F.sum("n").alias("an")).join(t, "bare").filter("tn >= an")
        drop = mine.join(wrong, ["field", "bare"], "left_semi").select("field", "value")
        parsed = parsed.join(drop, ["field", "value"], "left_anti")
    key = ["field", "what", "kind", "names", "first"]
    parsed = cut(parsed.withColumn("form", F.xxhash64(F.col("field"), F.col("what"), F.col("kind"), F.concat_ws("|", "names"), F.col("first"))))
    form = parsed.groupBy("form", *key).agg(F.sum("n").alias("n"))

    @F.pandas_udf("array<string>")
    def codes(what: pd.Series, kind: pd.Series, names: pd.Series, first: pd.Series) -> pd.Series:
        def one(w, k, ns, f):
            heads = {s[:1] for s in _standing(f)} | {f[:1]} if w == "person" else {k}
            return [f"{h}/{len(ns)}/{c}" for h in sorted(heads) for c in _codes(list(ns))]

        return pd.Series([one(*r) for r in zip(what, kind, names, first)])

    full = form.filter("what <> 'person' OR length(first) > 1")
    blocks = cut(full.withColumn("code", F.explode(codes("what", "kind", "names", "first"))))
    a, b = blocks.alias("a"), blocks.alias("b")
    cand = (
        a.join(b, [F.col("a.field") == F.col("b.field"), F.col("a.what") == F.col("b.what"), F.col("a.code") == F.col("b.code"), F.col("a.form") < F.col("b.form")])
        .filter(F.levenshtein(F.concat_ws("|", "a.names"), F.concat_ws("|", "b.names")) <= 4 * F.size("a.names"))
        .select(F.col("a.form").alias("src"), F.col("b.form").alias("dst"), F.col("a.names").alias("na"), F.col("b.names").alias("nb"), F.col("a.first").alias("fa"), F.col("b.first").alias("fb"))
        .distinct()
    )

    @F.pandas_udf("boolean")
    def accept(na: pd.Series, nb: pd.Series, fa: pd.Series, fb: pd.Series) -> pd.Series:
        return pd.Series([all(near(x, y) for x, y in zip(p, q)) and _same_first(f, g) for p, q, f, g in zip(na, nb, fa, fb)], dtype=bool)

    links = cand.filter(accept("na", "nb", "fa", "fb")).select("src", "dst")
    comp = connected_components(links)
    clusters = full.join(comp, full["form"] == comp["id"], "left").select("form", *key, "n", F.coalesce("component", "form").alias("entity"))
    clusters = cut(clusters)
    # short forms: initials, bare surnames, short names of several formal names
    short = form.filter("what = 'person' AND length(first) <= 1").unionByName(_several(form))
    sides = lambda df: df.withColumn("code", F.explode(_surname_codes()(F.col("names"))))
    s, c = sides(short).alias("s"), sides(clusters.filter("what = 'person'")).alias("c")
    fits = (
        s.join(c, [F.col("s.field") == F.col("c.field"), F.col("s.code") == F.col("c.code"), F.col("s.form") != F.col("c.form")])
        .filter(F.levenshtein(F.col("s.names")[0], F.col("c.names")[0]) <= 4)
        .select(F.col("s.form").alias("form"), F.col("c.entity").alias("entity"), F.col("c.form").alias("of"), F.col("c.n").alias("n"), F.col("s.names").alias("na"), F.col("c.names").alias("nb"), F.col("s.first").alias("fa"), F.col("c.first").alias("fb"))
        .distinct()
    )

    @F.pandas_udf("boolean")
    def may(na: pd.Series, nb: pd.Series, fa: pd.Series, fb: pd.Series) -> pd.Series:
        ok = lambda f, g: not f or (g[:1] == f or any(x[:1] == f for x in _standing(g)) if len(f) == 1 else bool(set(_standing(f)) & set(_standing(g))))
        return pd.Series([near(p[0], q[0]) and ok(f, g) for p, q, f, g in zip(na, nb, fa, fb)], dtype=bool)

    per = fits.filter(may("na", "nb", "fa", "fb")).groupBy("form", "entity").agg(F.sum("n").alias("n"))
    best = per.groupBy("form").agg(F.max_by("entity", F.struct("n", "entity")).alias("to"), F.max("n").alias("top"), F.sum("n").alias("all")).filter(F.col("top") >= dominance * F.col("all"))
    links = links.unionByName(best.select(F.col("form").alias("src"), F.col("to").alias("dst")))
    # short forms of one surname and initial that found no candidate still belong together by spelling
    comp = connected_components(links)
    named = parsed.join(comp, parsed["form"] == comp["id"], "left").select("field", "value", F.coalesce("component", "form").alias("entity"))
    named = cut(named)
    x, y = named.alias("x"), named.alias("y")
    return x.join(y, [F.col("x.entity") == F.col("y.entity"), F.col("x.field") == F.col("y.field"), F.col("x.value") < F.col("y.value")]).select(F.col("x.field").alias("field"), F.col("x.value").alias("name_a"), F.col("y.value").alias("name_b"))


def _several(form: DataFrame) -> DataFrame:
    """Persons whose given name is short for more than one formal name."""
    several = [n for n, fs in _FORMAL.items() if len(fs) > 1 and n not in NICKNAMES]
    return form.filter(F.col("what").eqNullSafe("person") & F.col("first").isin(several))


def _surname_codes():
    @F.pandas_udf("array<string>")
    def f(names: pd.Series) -> pd.Series:
        return names.map(lambda ns: _codes([ns[0]]))

    return f
