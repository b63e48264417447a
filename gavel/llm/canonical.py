"""Free-entered values mapped to a canonical list, in SQL only.

Two steps of one method, the partition-based pigeonhole join. A reference string of n characters allows k(n) edits and
is cut into k+1 segments; a string within k edits keeps one of them whole, shifted by at most k, so strings and
references meet by an equality join on (length, segment, substring), and the built-in levenshtein verifies what met.

1. Whole values against whole labels of their field, both cleaned (letter case, signs, what scanning confuses).
2. What step 1 leaves, word by word: words and pairs of neighbours against the words of the labels and of a thesaurus,
   by the same join, or as abbreviations (a beginning, or letters in order from the first to the last). Words stand for
   meanings; a value and a label are compared as sets of meanings, whatever their order, weighted by how few labels
   of the field have them. The label of the highest score wins, of equal ones the one
   that is spoken of first.

Values that reach no label are found by an anti-join and reported with canon_id 0.

Scale: one scan makes the values distinct (map-side combined, so a value that fills a third of the rows costs one row)
and writes them down once; everything after works on distinct values and distinct words. The references are a few
rows a label and are broadcast by Spark's own size threshold only. The way back to the rows is one equi-join on the
typed value, split by the skew-join rule where a value is hot.

Defined cases: null and blank values are no rows; a field without references maps to 0; repeated rows give equal
results; ties between labels go to the smaller canon_id; values of any length are compared whole; an empty thesaurus
leaves the labels' own words; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import cut

#: Words of one meaning in decisions and in what premises offer; the first names the meaning. A pair of words is written
#: together. General knowledge of the trade, not a list of values; callers may pass their own, or an empty list.
THESAURUS = """approve approved approval approves approving accept accepted ok okay grant granted favor favour carry carried aprobar aprobado aprobada
deny denied denies denial disapprove disapproved disapproval reject rejected refuse refused negado denegado notapproved notapprove votedown
stipulation stipulations stipulated stips stip proviso provisos estipulaciones
condition conditions conditional conditionally conds
met meets meet fulfilled satisfied
withdraw withdrawn withdrew withdraws retirado retirada pulled
applicant applicants petitioner owner solicitante
refer referred refers remand remanded return returned send sent forward forwarded fwd
committee committees subcommittee cmte comite
board boards bd junta
full whole entire complete
table tabled tabling tables
postpone postponed defer deferred delay delayed adjourn adjourned laidover putoff
meeting meetings mtg session month
next following subsequent
quorum quorums
lack lacking insufficient lost
fail failed fails failing
rescind rescinded rescinds revoke revoked repeal repealed annul annulled overturn overturned
recommend recommended recommends recommendation recommending advise advised urge urges suggest suggested recomienda recomendar
no none never nothing without
not did didn
action acted
take taken took takes
letter letters ltr
objection objections object objects
hold held holds onhold
further more additional
review reviewed consideration study
appear appeared appears appearance attend attended present absent noshow
site premises location place
visit visited visits inspect inspected inspection tour
request requested requests ask asked asks want wants need needs
split divided tie tied deadlock even evenly
vote votes voted voting ballot
modify modified modifies modification change changed changes adjust adjusted earlier later
hour hours hrs hr
sidewalk sidewalks pavement footpath
cafe cafes caffe coffee
rear back backyard
yard yards backyard courtyard patio garden backyard
rooftop roof roofs terrace
live vivo band bands performance performances
music musical musica
dj djs deejay discjockey
karaoke singalong singing
record recorded recording taped jukebox background
liquor spirits bar
beer beers cerveza ale cider
wine wines vino
only just
late later midnight night am
close closing closes closed open
outdoor outdoors outside exterior openair alfresco
private pvt privately
event events party parties function functions banquet banquets rental rentals
dance dancing dances dancefloor cabaret disco
pool pools billiard billiards snooker
roadway road roadbed roads curb curbside street lane
seating dining
security bouncer bouncers
guard guards bouncer bouncers staff
soundproof soundproofing soundproofed acoustic acoustics insulation insulated
hookah hooka shisha waterpipe waterpipes nargile
arcade video pinball
game games gaming
comedy comedian comedians standup
show shows night nights
delivery deliveries deliver delivered takeout takeaway
bottle bottles
service services svc""".split("\n")
#: Words that carry no meaning of their own.
STOP = "a an and are as at be been by del el en for from has have in is it its la of on or per por s that the this to was were with con w".split()
#: Edits that a reference string of a length allows: for whole labels, and for words.
EDITS = "CASE WHEN {n} < 3 THEN 0 WHEN {n} < 5 THEN 1 WHEN {n} < 15 THEN 2 ELSE 3 END"
WORD_EDITS = "CASE WHEN {n} < 4 THEN 0 WHEN {n} < 5 THEN 1 ELSE 2 END"
#: Letters with and without their accents.
ACCENTED, PLAIN = "áàâäãåąćčçéèêëęíìîïłñńóòôöõśšúùûüýźżž", "aaaaaaaccceeeeeiiiilnnooooossuuuuyzzz"
#: (pattern, replacement with $1) in order, on lower case: digits and letter pairs that scanning confuses, numbers, signs.
CLEAN = [*[x for d, c in (("0", "o"), ("1", "l"), ("5", "s")) for x in ((f"([a-z]){d}", f"$1{c}"), (f"([a-z]){d}", f"$1{c}"), (f"{d}([a-z])", f"{c}$1"))], ("cl", "d"), ("rn", "m"), (r"[0-9]+", "#"), (r"[^#\p{L}]+", " ")]
#: Least score (of 1) of an accepted label, and the weight of a word that means nothing in the field (others have 100 to 300).
LEAST, UNKNOWN = 0.44, 250


def cleaned(col: str, backslash: bool = False) -> str:
    """The cleaning as a SQL expression; with backslash in the dialect that writes groups as \\1 and takes the flag 'g'."""
    e = f"translate(lower({col}), '{ACCENTED}', '{PLAIN}')"
    for pattern, by in CLEAN:
        if backslash:
            e = f"regexp_replace({e}, '{pattern}', '{by.replace('$', chr(92))}', 'g')"
        else:
            e = f"regexp_replace({e}, r'{pattern}', '{by}')"
    return f"trim({e})"


def thesaurus_sql(thesaurus: list[str]) -> str:
    """(word, meaning) as a VALUES list, words as they are after cleaning; one row that matches nothing where it is empty."""
    pairs = sorted({(w, line.split()[0]) for line in thesaurus for w in line.split()}) or [("#", "#")]
    return "VALUES " + ", ".join(f"('{w}', '{m}')" for w, m in pairs)


def typed_values(df: DataFrame, id_col: str, single: list[str], arrays: list[str]) -> DataFrame:
    """(license_id-like id, field, pos, value) of every non-blank value in one scan: pos 0 for columns, from 1 in arrays."""
    one = [f"array(named_struct('field', '{c}', 'pos', 0L, 'value', `{c}`))" for c in single]
    many = [f"coalesce(transform(`{c}`, (v, i) -> named_struct('field', '{c}', 'pos', CAST(i + 1 AS BIGINT), 'value', v)), array())" for c in arrays]
    return df.sparkSession.sql(
        f"""SELECT id, x.field, x.pos, x.value FROM (SELECT `{id_col}` AS id, explode(concat({", ".join(one + many)})) AS x FROM {{d}} WHERE `{id_col}` IS NOT NULL)"""
        r" WHERE x.value RLIKE r'[^\s\p{{Z}}]'",
        d=df,
    )


def near(texts: DataFrame, references: DataFrame, edits: str) -> DataFrame:
    """(field, text, ref, d): pairs of texts (field, text) and references (field, ref) within the edits that the reference allows."""
    spark = texts.sparkSession
    # k+1 segments of a reference: segment s begins at s*n div (k+1)
    segments = spark.sql(
        f"""SELECT field, ref, n, k, s, CAST(s * n DIV (k + 1) AS INT) AS a, substring(ref, CAST(s * n DIV (k + 1) AS INT) + 1, CAST((s + 1) * n DIV (k + 1) - s * n DIV (k + 1) AS INT)) AS part
            FROM (SELECT field, ref, length(ref) AS n, {edits.format(n="length(ref)")} AS k FROM {{r}}) LATERAL VIEW explode(sequence(0, k)) x AS s""",
        r=references,
    )
    shapes = spark.sql("SELECT DISTINCT field, n, k, s, a, length(part) AS len FROM {g}", g=segments)
    # the substrings of a text that may be a segment: for each shape of nearly its length, at each shift
    probes = spark.sql(
        """SELECT DISTINCT field, text, n, s, substring(text, at + 1, len) AS part FROM (
             SELECT t.field, t.text, h.n, h.s, h.len, explode(sequence(greatest(0, h.a - h.k), greatest(0, least(h.a + h.k, t.m - h.len)))) AS at
             FROM (SELECT field, text, length(text) AS m, explode(sequence(greatest(1, length(text) - 4), length(text) + 4)) AS n FROM {t}) t JOIN {h} h ON h.field = t.field AND h.n = t.n
             WHERE abs(t.m - h.n) <= h.k) WHERE length(substring(text, at + 1, len)) = len""",
        t=texts,
        h=shapes,
    )
    return spark.sql(
        """SELECT DISTINCT field, text, ref, d FROM (
             SELECT p.field, p.text, g.ref, g.k, levenshtein(p.text, g.ref) AS d FROM {p} p JOIN {g} g ON g.field = p.field AND g.n = p.n AND g.s = p.s AND g.part = p.part) WHERE d <= k""",
        p=probes,
        g=segments,
    )


#: A word as an abbreviation of another: its beginning, or its letters in order from the first to the last.
#: Two edits in a word of less than seven letters are accepted only where letters changed places.
_SWAPPED = "d < 2 OR length({r}) > 6 OR {sorted_w} = {sorted_r}"
_SHORT = "length({w}) < length({r}) AND (length({w}) > 2 AND left({r}, length({w})) = {w} OR length({w}) > 2 AND right({w}, 1) = right({r}, 1) AND {like})"


def map_values(typed: DataFrame, canon: DataFrame, thesaurus: list[str] | None = None) -> DataFrame:
    """(id, field, pos, canon_id) of every typed value (id, field, pos, value) that is not literally a label; 0 = none."""
    spark = typed.sparkSession
    fix = lambda e: e.replace(r"\p{L}", r"\p{{L}}")
    distinct = cut(
        spark.sql(
            fix(f"""SELECT t.field, t.value, {cleaned("t.value")} AS text FROM (SELECT DISTINCT field, value FROM {{t}}) t LEFT ANTI JOIN {{c}} c ON c.field = t.field AND c.label = t.value"""),
            t=typed,
            c=canon,
        )
    )
    labels = spark.sql(fix(f"""SELECT field, text AS ref, min(canon_id) AS canon_id FROM (SELECT field, canon_id, {cleaned("label")} AS text FROM {{c}} WHERE canon_id IS NOT NULL) WHERE text <> '' GROUP BY field, text"""), c=canon)
    texts = spark.sql("SELECT DISTINCT field, text FROM {d} WHERE text <> ''", d=distinct)
    # whole values
    whole = cut(spark.sql("SELECT n.field, n.text, min_by(l.canon_id, struct(n.d, l.canon_id)) AS canon_id FROM {n} n JOIN {l} l ON l.field = n.field AND l.ref = n.ref GROUP BY n.field, n.text", n=near(texts, labels.select("field", "ref"), EDITS), l=labels))
    rest = spark.sql("SELECT t.* FROM {t} t LEFT ANTI JOIN {w} w ON w.field = t.field AND w.text = t.text", t=texts, w=whole)
    # words of the labels and their meanings; the initials of a label of three words and more stand for all its meanings
    stop = ", ".join(f"'{w}'" for w in STOP)
    known = spark.sql(f"SELECT word, meaning FROM (SELECT {cleaned('col1')} AS word, col2 AS meaning FROM ({thesaurus_sql(THESAURUS if thesaurus is None else thesaurus)})) GROUP BY word, meaning")
    own = spark.sql(f"SELECT DISTINCT field, canon_id, word FROM (SELECT field, canon_id, explode(split(ref, ' ')) AS word FROM {{l}}) WHERE word NOT IN ({stop})", l=labels)
    meant = cut(spark.sql("SELECT DISTINCT o.field, o.canon_id, coalesce(k.meaning, o.word) AS meaning FROM {o} o LEFT JOIN {k} k ON k.word = o.word", o=own, k=known))
    weights = spark.sql(
        """SELECT m.field, m.meaning, CAST(round(100 * ln(1 + f.n / count(*))) AS BIGINT) AS w
           FROM {m} m JOIN (SELECT field, count(DISTINCT canon_id) AS n FROM {m} GROUP BY field) f ON f.field = m.field GROUP BY m.field, m.meaning, f.n""",
        m=meant,
    )
    initials = f"SELECT field, canon_id, array_join(transform(filter(split(ref, ' '), x -> NOT array_contains(array({stop}), x)), x -> left(x, 1)), '') AS word FROM {{l}} WHERE size(filter(split(ref, ' '), x -> NOT array_contains(array({stop}), x))) > 2"
    vocabulary = cut(
        spark.sql(
            f"""SELECT DISTINCT field, word AS ref, meaning FROM (
                  SELECT o.field, o.word, coalesce(k.meaning, o.word) AS meaning FROM {{o}} o LEFT JOIN {{k}} k ON k.word = o.word
                  UNION ALL SELECT m.field, k.word, k.meaning FROM {{k}} k JOIN (SELECT DISTINCT field, meaning FROM {{m}}) m ON m.meaning = k.meaning
                  UNION ALL SELECT i.field, i.word, m.meaning FROM ({initials}) i JOIN {{m}} m ON m.field = i.field AND m.canon_id = i.canon_id) WHERE word <> ''""",
            o=own,
            k=known,
            m=meant,
            l=labels,
        )
    )
    # words of the values, and neighbours written together
    words = cut(
        spark.sql(
            f"""SELECT field, text, p, 1 AS span, t[p] AS word FROM (SELECT field, text, split(text, ' ') AS t, explode(sequence(0, size(split(text, ' ')) - 1)) AS p FROM {{r}}) WHERE t[p] <> '#'
                UNION ALL SELECT field, text, p, 2, concat(t[p], t[p + 1]) FROM (SELECT field, text, split(text, ' ') AS t, explode(sequence(0, size(split(text, ' ')) - 2)) AS p FROM {{r}} WHERE size(split(text, ' ')) > 1) WHERE t[p] <> '#' AND t[p + 1] <> '#'""",
            r=rest,
        )
    )
    tokens = spark.sql(f"SELECT DISTINCT field, word AS text FROM {{w}} WHERE word NOT IN ({stop})", w=words)
    refs = spark.sql("SELECT DISTINCT field, ref FROM {v}", v=vocabulary)
    like = "{r} RLIKE concat('^', regexp_replace({w}, '(.)', '$1.*'))".format(r="r.ref", w="t.text")
    short = spark.sql(f"SELECT t.field, t.text, r.ref, CASE WHEN left(r.ref, length(t.text)) = t.text THEN 1 ELSE 3 END AS d FROM {{t}} t JOIN {{r}} r ON r.field = t.field AND left(r.ref, 1) = left(t.text, 1) WHERE {_SHORT.format(w='t.text', r='r.ref', like=like)}", t=tokens, r=refs)
    swapped = _SWAPPED.format(r="ref", sorted_w="array_sort(split(text, ''))", sorted_r="array_sort(split(ref, ''))")
    read = spark.sql(
        f"SELECT field, text AS word, min(struct(d, length(ref), ref)) AS best FROM (SELECT field, text, ref, 2 * d AS d FROM {{n}} WHERE {swapped} UNION ALL SELECT * FROM {{s}}) GROUP BY field, text",
        n=near(tokens, refs, WORD_EDITS),
        s=short,
    )
    read = spark.sql("SELECT field, word, best.d AS d, best.ref AS ref FROM {r}", r=read)
    met = spark.sql("SELECT w.*, r.d, r.ref FROM {w} w JOIN {r} r ON r.field = w.field AND r.word = w.word WHERE w.span = 1 OR r.d IN (0, 2, 4) OR r.d = 3 AND length(w.word) > 4", w=words, r=read)
    # a pair is no word where one of its two says as much
    hits = cut(spark.sql("SELECT h.* FROM {h} h LEFT ANTI JOIN {h} o ON h.span = 2 AND o.span = 1 AND o.field = h.field AND o.text = h.text AND o.ref = h.ref AND o.p BETWEEN h.p AND h.p + 1", h=met))
    # a pair that is one known word stands for both its words
    free = spark.sql("SELECT h.* FROM {h} h LEFT ANTI JOIN (SELECT field, text, p + x AS p FROM {h} LATERAL VIEW explode(array(0, 1)) e AS x WHERE span = 2) b ON h.span = 1 AND b.field = h.field AND b.text = h.text AND b.p = h.p", h=hits)
    said = spark.sql("SELECT h.field, h.text, v.meaning, min(h.p) AS p FROM {h} h JOIN {v} v ON v.field = h.field AND v.ref = h.ref GROUP BY h.field, h.text, v.meaning", h=free, v=vocabulary)
    scored = spark.sql(
        f"""SELECT s.field, s.text, m.canon_id, sum(g.w) AS both, min(s.p) AS p FROM {{s}} s JOIN {{m}} m ON m.field = s.field AND m.meaning = s.meaning JOIN {{g}} g ON g.field = s.field AND g.meaning = s.meaning GROUP BY s.field, s.text, m.canon_id""",
        s=said,
        m=meant,
        g=weights,
    )
    mine = spark.sql(
        f"""SELECT a.field, a.text, a.w + {UNKNOWN} * coalesce(u.n, 0) AS w FROM (SELECT s.field, s.text, sum(g.w) AS w FROM {{s}} s JOIN {{g}} g ON g.field = s.field AND g.meaning = s.meaning GROUP BY s.field, s.text) a
            LEFT JOIN (SELECT w.field, w.text, count(*) AS n FROM {{w}} w LEFT ANTI JOIN (SELECT field, text, p + x AS p FROM {{h}} LATERAL VIEW explode(sequence(0, span - 1)) e AS x) h ON h.field = w.field AND h.text = w.text AND h.p = w.p
                       WHERE w.span = 1 AND w.word NOT IN ({stop}) GROUP BY w.field, w.text) u ON u.field = a.field AND u.text = a.text""",
        s=said,
        g=weights,
        w=words,
        h=hits,
    )
    theirs = spark.sql("SELECT m.field, m.canon_id, sum(g.w) AS w FROM {m} m JOIN {g} g ON g.field = m.field AND g.meaning = m.meaning GROUP BY m.field, m.canon_id", m=meant, g=weights)
    by_words = spark.sql(
        f"""SELECT field, text, min_by(canon_id, struct(-score, p, canon_id)) AS canon_id FROM (
              SELECT c.field, c.text, c.canon_id, c.p, 2.0D * c.both / (a.w + b.w) AS score FROM {{c}} c JOIN {{a}} a ON a.field = c.field AND a.text = c.text JOIN {{b}} b ON b.field = c.field AND b.canon_id = c.canon_id)
            WHERE score >= {LEAST} GROUP BY field, text""",
        c=scored,
        a=mine,
        b=theirs,
    )
    met = cut(whole.unionByName(by_words))
    values = spark.sql(
        """SELECT d.field, d.value, m.canon_id FROM {d} d JOIN {m} m ON m.field = d.field AND m.text = d.text
           UNION ALL
           SELECT d.field, d.value, CAST(0 AS BIGINT) FROM {d} d LEFT ANTI JOIN {m} m ON m.field = d.field AND m.text = d.text""",
        d=distinct,
        m=met,
    )
    return spark.sql("SELECT t.id, t.field, t.pos, v.canon_id FROM {t} t JOIN {v} v ON v.field = t.field AND v.value = t.value", t=typed, v=values)


def oracle(id_col: str, table: str, canon: str, single: list[str], arrays: list[str]) -> str:
    """The same mapping without segments, every string against every reference, for a plain SQL engine."""
    parts = [f"SELECT {id_col} AS id, '{c}' AS field, CAST(0 AS BIGINT) AS pos, {c} AS value FROM {table}" for c in single]
    parts += [f"SELECT {id_col}, '{c}', CAST(unnest(generate_series(1, len({c}))) AS BIGINT), unnest({c}) FROM {table}" for c in arrays]
    stop = ", ".join(f"'{w}'" for w in STOP)
    heads = f"list_filter(string_split(ref, ' '), lambda x: NOT list_contains([{stop}], x))"
    like = "regexp_matches(r.ref, '^' || regexp_replace(t.word, '(.)', '\\1.*', 'g'))"
    swapped = _SWAPPED.format(r="ref", sorted_w="list_sort(string_split(word, ''))", sorted_r="list_sort(string_split(ref, ''))")
    return f"""WITH t AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE regexp_matches(value, '[^\\s\\p{{Z}}]')),
    d AS MATERIALIZED (SELECT DISTINCT field, value, {cleaned("value", True)} AS text FROM t WHERE NOT EXISTS (SELECT 1 FROM {canon} c WHERE c.field = t.field AND c.label = t.value)),
    l AS MATERIALIZED (SELECT field, text AS ref, min(canon_id) AS canon_id FROM (SELECT field, canon_id, {cleaned("label", True)} AS text FROM {canon}) WHERE text <> '' GROUP BY ALL),
    x AS (SELECT DISTINCT field, text FROM d WHERE text <> ''),
    whole AS MATERIALIZED (SELECT field, text, canon_id FROM (SELECT x.field, x.text, l.canon_id, row_number() OVER (PARTITION BY x.field, x.text ORDER BY levenshtein(x.text, l.ref), l.canon_id) AS rn
              FROM x JOIN l ON l.field = x.field WHERE levenshtein(x.text, l.ref) <= {EDITS.format(n="length(l.ref)")}) WHERE rn = 1),
    rest AS MATERIALIZED (SELECT field, text, string_split(text, ' ') AS t FROM x WHERE NOT EXISTS (SELECT 1 FROM whole w WHERE w.field = x.field AND w.text = x.text)),
    k AS MATERIALIZED (SELECT DISTINCT {cleaned("col0", True)} AS word, col1 AS meaning FROM ({thesaurus_sql(THESAURUS)})),
    own AS (SELECT DISTINCT * FROM (SELECT field, canon_id, unnest(string_split(ref, ' ')) AS word FROM l) WHERE word NOT IN ({stop})),
    m AS MATERIALIZED (SELECT DISTINCT o.field, o.canon_id, coalesce(k.meaning, o.word) AS meaning FROM own o LEFT JOIN k ON k.word = o.word),
    g AS MATERIALIZED (SELECT m.field, m.meaning, CAST(round(100 * ln(1 + f.n / count(*))) AS BIGINT) AS w FROM m JOIN (SELECT field, count(DISTINCT canon_id) AS n FROM m GROUP BY field) f ON f.field = m.field GROUP BY m.field, m.meaning, f.n),
    v AS MATERIALIZED (SELECT DISTINCT field, word AS ref, meaning FROM (SELECT o.field, o.word, coalesce(k.meaning, o.word) AS meaning FROM own o LEFT JOIN k ON k.word = o.word
         UNION ALL SELECT q.field, k.word, k.meaning FROM k JOIN (SELECT DISTINCT field, meaning FROM m) q ON q.meaning = k.meaning
         UNION ALL SELECT i.field, i.word, m.meaning FROM (SELECT field, canon_id, array_to_string(list_transform({heads}, lambda x: left(x, 1)), '') AS word FROM l WHERE len({heads}) > 2) i JOIN m ON m.field = i.field AND m.canon_id = i.canon_id) WHERE word <> ''),
    words AS MATERIALIZED (SELECT field, text, p, 1 AS span, t[p] AS word FROM (SELECT field, text, t, unnest(generate_series(1, len(t))) AS p FROM rest) WHERE t[p] <> '#'
         UNION ALL SELECT field, text, p, 2, t[p] || t[p + 1] FROM (SELECT field, text, t, unnest(generate_series(1, len(t) - 1)) AS p FROM rest WHERE len(t) > 1) WHERE t[p] <> '#' AND t[p + 1] <> '#'),
    tokens AS (SELECT DISTINCT field, word FROM words WHERE word NOT IN ({stop})),
    refs AS MATERIALIZED (SELECT DISTINCT field, ref FROM v),
    near AS (SELECT t.field, t.word, r.ref, levenshtein(t.word, r.ref) AS d FROM tokens t JOIN refs r ON r.field = t.field WHERE abs(length(t.word) - length(r.ref)) <= 2 AND levenshtein(t.word, r.ref) <= {WORD_EDITS.format(n="length(r.ref)")}),
    short AS (SELECT t.field, t.word, r.ref, CASE WHEN left(r.ref, length(t.word)) = t.word THEN 1 ELSE 3 END AS d FROM tokens t JOIN refs r ON r.field = t.field AND left(r.ref, 1) = left(t.word, 1) WHERE {_SHORT.format(w="t.word", r="r.ref", like=like)}),
    readings AS MATERIALIZED (SELECT field, word, d, ref FROM (SELECT *, row_number() OVER (PARTITION BY field, word ORDER BY d, length(ref), ref) AS rn FROM (SELECT field, word, ref, 2 * d AS d FROM near WHERE {swapped} UNION ALL SELECT * FROM short)) WHERE rn = 1),
    met AS MATERIALIZED (SELECT w.*, r.d, r.ref FROM words w JOIN readings r ON r.field = w.field AND r.word = w.word WHERE w.span = 1 OR r.d IN (0, 2, 4) OR r.d = 3 AND length(w.word) > 4),
    h AS MATERIALIZED (SELECT * FROM met a WHERE a.span = 1 OR NOT EXISTS (SELECT 1 FROM met o WHERE o.span = 1 AND o.field = a.field AND o.text = a.text AND o.ref = a.ref AND o.p BETWEEN a.p AND a.p + 1)),
    free AS (SELECT * FROM h a WHERE a.span = 2 OR NOT EXISTS (SELECT 1 FROM h b WHERE b.span = 2 AND b.field = a.field AND b.text = a.text AND a.p BETWEEN b.p AND b.p + 1)),
    said AS MATERIALIZED (SELECT a.field, a.text, v.meaning, min(a.p) AS p FROM free a JOIN v ON v.field = a.field AND v.ref = a.ref GROUP BY ALL),
    scored AS (SELECT s.field, s.text, m.canon_id, sum(g.w) AS both_w, min(s.p) AS p FROM said s JOIN m ON m.field = s.field AND m.meaning = s.meaning JOIN g ON g.field = s.field AND g.meaning = s.meaning GROUP BY ALL),
    unknown AS (SELECT w.field, w.text, count(*) AS n FROM words w WHERE w.span = 1 AND w.word NOT IN ({stop}) AND NOT EXISTS (SELECT 1 FROM h a WHERE a.field = w.field AND a.text = w.text AND w.p BETWEEN a.p AND a.p + a.span - 1) GROUP BY ALL),
    mine AS (SELECT a.field, a.text, a.w + {UNKNOWN} * coalesce(u.n, 0) AS w FROM (SELECT s.field, s.text, sum(g.w) AS w FROM said s JOIN g ON g.field = s.field AND g.meaning = s.meaning GROUP BY ALL) a LEFT JOIN unknown u ON u.field = a.field AND u.text = a.text),
    theirs AS (SELECT m.field, m.canon_id, sum(g.w) AS w FROM m JOIN g ON g.field = m.field AND g.meaning = m.meaning GROUP BY ALL),
    by_words AS (SELECT field, text, canon_id FROM (SELECT *, row_number() OVER (PARTITION BY field, text ORDER BY score DESC, p, canon_id) AS rn FROM (
         SELECT c.field, c.text, c.canon_id, c.p, CAST(2 * c.both_w AS DOUBLE) / CAST(a.w + b.w AS DOUBLE) AS score FROM scored c JOIN mine a ON a.field = c.field AND a.text = c.text JOIN theirs b ON b.field = c.field AND b.canon_id = c.canon_id)
         WHERE score >= {LEAST}) WHERE rn = 1),
    best AS (SELECT * FROM whole UNION ALL SELECT * FROM by_words)
    SELECT t.id AS license_id, t.field, t.pos, CAST(coalesce(b.canon_id, 0) AS BIGINT) AS canon_id
    FROM t JOIN d ON d.field = t.field AND d.value = t.value LEFT JOIN best b ON b.field = d.field AND b.text = d.text"""
