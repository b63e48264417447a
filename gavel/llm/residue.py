"""Template residue, filler, error pages and script notices instead of content.

Two positive-unlabelled naive Bayes models are fitted by expectation-maximization, each from trusted records (written
below, or the caller's) and a bounded unlabelled sample of the corpus:

* records: word features, classes residue / content. Its word weights are the log-odds of the passages (sentences and
  lines) of every record; the prior comes from the fit. A record's log-odds are the prior, what its passages say for
  residue, and `COST` times what they say against it; headings and navigation say little. Above 0 it is residue.
* slots: every stretch that its form sets apart, with its delimiters, inner words and surroundings, classes unfilled
  placeholder / ordinary: what stands between brackets of any kind or between two like signs, runs of one letter or sign
  as they hold places in masks, words grown together. Which of them are placeholders is learned. One makes a record residue.

Scale: one scan with an Arrow-batched scorer, no shuffle. Fitting is one task on an executor over `sample_rows` distinct
texts drawn by the smallest hashes (a top-k, so no full sort), of each at most `sample_chars` characters from a place
drawn by the hash; only the weights, bounded by that sample, reach the driver. Scoring covers all records and whole texts.

Defined cases: null, empty and blank texts are no cases; a text that occurs twice is decided alike; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Records known to be residue, in wordings of many sites: errors, access messages, script notices, filler.
TRUSTED = [
    "Error 404: the requested page was not found on this server. It may have been moved or deleted.",
    "We can't find the page you are looking for. Check the address for mistakes or go back to the home page.",
    "This link is broken or the page has been removed. Return to the homepage.",
    "403: you don't have permission to view this resource. Log in or contact the site administrator.",
    "Access to this document is restricted. Please sign in with an authorized account.",
    "You are not authorized to open this file. Ask the administrator for access.",
    "Internal server error. The server encountered an unexpected condition. Request id 7f3a9. Please try again later.",
    "An unexpected error has occurred while processing your request. Code 5012. Try again in 10 minutes.",
    "502 bad gateway. The upstream server did not answer in time. Request id 88c1. Try again in a few minutes.",
    "Service temporarily unavailable. We are down for scheduled maintenance and will be back soon.",
    "Gateway timeout. The server took too long to respond.",
    "Too many requests. Slow down, or confirm that you are a human to continue.",
    "Checking your connection before you continue to the site. Complete the captcha to verify that you are not a robot.",
    "Your session has ended because of inactivity. Log in again to continue.",
    "The session timed out. Sign in and reload the page.",
    "Something went wrong and this page could not be loaded. Refresh the window or try again.",
    "Sorry, this file can't be displayed. It is corrupt, empty or damaged. (upload_4471.docx)",
    "Failed to open the document: the file is damaged. (77120.pdf)",
    "Unable to render preview. KeyError: 'title' null undefined",
    "Traceback (most recent call last): ValueError: cannot read property of undefined null NaN",
    "Uncaught TypeError: undefined is not an object. null null undefined",
    "This application needs JavaScript. Enable scripts in your browser settings and reload.",
    "JavaScript seems to be turned off. Switch it on to use this viewer.",
    "To see the content, allow scripts and cookies for this site, then refresh.",
    "Loading, please wait. If the page stays blank, enable JavaScript.",
    "Your browser is out of date and cannot show this page. Install a newer browser or update it.",
    "Unsupported browser. Upgrade to a modern browser that runs scripts to read this content.",
    "We're sorry, the portal does not work without JavaScript enabled.",
    "Debe habilitar JavaScript en el navegador para usar este sitio. Recargue la página.",
    "Este sitio requiere JavaScript. Actívelo y vuelva a cargar. Su navegador no es compatible.",
    "La página que busca no existe o ha cambiado de dirección. Compruebe la dirección o vuelva al inicio.",
    "No tiene permiso para ver este archivo. Inicie sesión o contacte con el administrador.",
    "Ha ocurrido un error en el servidor. Inténtelo otra vez dentro de unos minutos.",
    "El archivo está dañado o vacío y no se puede abrir el documento.",
    "La sesión ha terminado. Inicie sesión otra vez para continuar.",
    "Do wyświetlenia strony potrzebny jest JavaScript. Włącz obsługę skryptów w przeglądarce i spróbuj ponownie.",
    "Przeglądarka jest nieaktualna lub blokuje skrypty. Zaktualizuj ją, aby zobaczyć dokument.",
    "Strona nie istnieje albo została przeniesiona. Sprawdź adres. Nie znaleziono strony.",
    "Nie masz dostępu do tego pliku. Zaloguj się albo skontaktuj z administratorem. Brak uprawnień.",
    "Wystąpił błąd serwera. Spróbuj ponownie za kilka minut.",
    "Pliku nie można otworzyć, jest uszkodzony lub pusty.",
    "Twoja sesja wygasła. Zaloguj się jeszcze raz.",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip. Lorem ipsum. Lorem ipsum.",
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.",
    "Type your text here. Type your text here. Add a description. Add your text.",
    "This is sample text. Sample text, sample text. Placeholder copy. Replace with your own content.",
    "Insert content here. Dummy text. Dummy text. Text to follow. Copy goes here. Your text here.",
    "Click here to edit this paragraph and add your own words.",
    "Texto de relleno. Escriba aquí. Texto de muestra. Ejemplo de texto.",
    "Tekst zastępczy. Wpisz tekst. Tu wpisz treść. Tekst przykładowy.",
    "bla bla bla bla bla bla",
    "blah blah blah blah blah",
    "xxxxxxxxxxxxxxxxxxxx xxxxxxxxxxxxxxxxxxxx xxxxxxxxxxxxxxxx",
    "test test test asdf asdf qwerty qwer zxcv asdf jkl; test test",
]
_FIELDS = ["name", "date", "company", "location", "address", "address_line1", "phone", "case no", "order no", "product name", "Customer Name", "RECIPIENT", "start_date", "last_name", "GrandTotal", "line2", "amount", "title", "city"]
_FORMS = ["{{%s}}", "{{ %s }}", "${%s}", "#{%s}", "{%s}", "<%%= %s %%>", "<%s>", "<<%s>>", "«%s»", "[[%s]]", "[INSERT %s HERE]", "[%s goes here]", "[TO BE FILLED: %s]", "[enter %s]", "(type %s)", "(insert %s here)", "%%%%%s%%%%", "@@%s@@", "__%s__", "$%s$", "%%%s%%", "##%s##"]
#: Surroundings in which a trusted placeholder stands.
_AROUND = [("the owner of ", " sent a plan"), ("Dear ", ", your order"), ("held on ", "."), ("Present: ", ", 12"), ("checked on June ", ". The"), ("will be seen on ", " at"), ("write to ", " before"), ("with ", " doors"), ("", "\n")]
_MASKS = ["FirstName LastName", "Firstname Lastname", "CompanyName", "123 Any Street", "123 Any Street Here", "1234 Sample Road", "(XXX) XXX-XXXX", "XXX-XXX-XXXX", "XX/XX/20XX", "XX/XX/XXXX", "MM/DD/YYYY", "DD/MM/YYYY", "__/__/____", "##/##/####", "$X,XXX", "$XX.XX", "########", "______"]
TRUSTED_SLOTS = [a + form % field + b for i, field in enumerate(_FIELDS) for j, form in enumerate(_FORMS) for a, b in [_AROUND[(3 * i + j) % len(_AROUND)]]] + [a + x + b for x in _MASKS for a, b in _AROUND * 2]
#: A stretch that its form sets apart, of any length within a line: between brackets, between two like signs, a mask of
#: repeated letters or signs, words grown together, a counted-off number before capitals, an abbreviation for 'to come'.
_SLOT = re.compile(
    r"[$#]?\{+[^{}\n]+\}+|<%=?[^%\n]+%>|<+/?[A-Za-z_][^<>\n]*>+|«[^«»\n]+»|\[+[^\[\]\n]+\]+"
    r"|(?<![\w$%@_#*~|])([$%@_#*~|])\1?(?=[A-Za-z])[^\n]*?(?<=\w)\1{1,2}(?!\w)"
    r"|(?<![^\W_])\(?(?:([A-Z_#?])\2+)\)?(?:[-/., ]\d{0,2}([A-Z_#?])\3+)*(?![^\W_])|\$([A-Z#_])(?:[,.]?\4)+|\([^()\n]+\)"
    r"|\b(?:[A-Z][a-z]+[A-Z]\w*)(?: [A-Z][a-z]+[A-Z]\w*)*|\b[Ff]irst[Nn]ame [Ll]ast[Nn]ame|\b1234?5?(?: [A-Z]\w+){2,3}|\bTB[ACD]\b"
)
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|\d+|;")
_SPLIT = re.compile(r"\n+|(?<=[.!?])\s+(?=[^\W\d_a-z])")
_HOST = re.compile(r"\b[\w-]+(?:\.[\w-]+)*\.(?:example|test|invalid|org|com|net|gov|edu)\b(?:\.org)?", re.I)


def words(text: str) -> list[str]:
    """Word features of a passage: words and pairs of words, numbers and host names as one each."""
    t = [("#" if w.isdigit() else "x~" if len(w) > 7 and len(set(w)) == 1 else w) for w in _WORD.findall(_HOST.sub(" hostname ", text).lower())]
    return t + [f"{a} {b}" for a, b in zip(t, t[1:])]


def passages(text: str) -> list[str]:
    return [p.strip() for p in _SPLIT.split(text) if p and p.strip()]


def slots(text: str) -> list[list[str]]:
    """Features of every stretch that may be a placeholder."""
    out = []
    for m in _SLOT.finditer(text):
        s = m.group()
        inner = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", s))
        before, after = text[max(0, m.start() - 12) : m.start()], text[m.end() : m.end() + 12]
        quoted = bool(re.search(r"(?<!\w)['\"“‘]\S*(?: \S+)? ?$", before)) and bool(re.match(r"[\w ]*['\"”’](?!\w)", after))
        mask = re.sub(r"[^\W\d_]+", lambda w: w.group() if re.fullmatch(r"[XMDY]+", w.group()) else "w", s)
        mask = re.sub(r"(?:w[ _]?)+", "w", re.sub(r"\d+", "9", mask))
        left, right = re.match(r"[^\w\s]*", s).group(), re.search(r"[^\w\s]*$", s).group()
        f = [f"edge:{left}|{right}", f"mask:{mask}"]
        f += [f"in:{left[:1]}{w.lower()}" for w in inner[:6]] + [f"in:{w.lower()}" for w in inner[:6]]
        f += [f"quoted:{quoted}"] * 2
        f.append(f"case:{'up' if s.isupper() else 'low' if s.islower() else 'mix'}")
        out.append(f)
    return out


def fit(positive: list[list[str]], unlabelled: list[list[str]], rounds: int = 8, trust: float = 4.0, mu: float = 0.25, prior: float = 0.1, odds: float | None = None) -> tuple[dict[str, float], float]:
    """Weights log P(f|positive)/P(f|rest) and the prior log-odds, by EM with the trusted side held at 1.

    Both classes are smoothed toward the corpus, with `mu` of their own mass: a feature that the positive side never
    showed speaks mildly against it however rare it is. `trust` multiplies the trusted records; `odds` fixes the prior log-odds,
    which otherwise follow the share of positives.
    """
    vocab: dict[str, int] = {}
    rows = [np.fromiter((vocab.setdefault(f, len(vocab)) for f in r), np.int64, len(r)) for r in [*positive, *unlabelled]]
    if not rows or not vocab:
        return {}, 0.0
    n = np.array([len(r) for r in rows])
    ids, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), n)
    held = np.arange(len(rows)) < len(positive)
    scale = np.where(held, trust, 1.0)
    base = np.bincount(ids, scale[owner], len(vocab))
    base /= base.sum()
    post = np.where(held, 1.0, prior)
    if not len(unlabelled):
        return {f: 1.0 for f in vocab}, 0.0
    lean = 0.0
    for r in range(rounds):
        pos = np.bincount(ids, (post * scale)[owner], len(vocab))
        neg = np.bincount(ids, ((1 - post) * scale)[owner], len(vocab))
        if r == 0:  # the mass lent to the unlabelled side only serves the prior
            pos = np.bincount(ids, (held * scale)[owner], len(vocab))
        w = np.log((pos / max(pos.sum(), 1e-9) + mu * base) / (neg / max(neg.sum(), 1e-9) + mu * base))
        share = float(np.clip(post[~held].mean(), 1e-4, 0.5))
        lean = math.log(share / (1 - share)) if odds is None else odds
        new = np.where(held, 1.0, 1 / (1 + np.exp(-np.clip(lean + np.bincount(owner, w[ids], len(rows)), -40, 40))))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-3:
            break
    return {f: float(w[k]) for f, k in vocab.items()}, lean


#: How much more a passage of content weighs than one of residue: what it costs to lose content.
COST = 3.0


class Model:
    """Fitted weights and the record decision."""

    def __init__(self, records: tuple[dict[str, float], float], slot: tuple[dict[str, float], float]):
        (self.records, self.lean), (self.slot, self.slot_odds) = records, slot

    def placeholder(self, text: str) -> bool:
        return any(self.slot_odds + sum(self.slot.get(f, 0.0) for f in s) > 0 for s in slots(text))

    def passage(self, p: str) -> tuple[float, int]:
        """Summed weight of the known features, and how many words the passage has."""
        f = words(p)
        return sum(self.records.get(x, 0.0) for x in f), sum(" " not in x for x in f)

    def log_odds(self, text: str) -> float:
        """The record's log-odds of being residue, aggregated over its passages."""
        total = self.lean
        for p in passages(text):
            s, n = self.passage(p)
            # only a sentence says something against residue; headings, navigation and captions do not
            if s > 0:
                total += s
            elif n >= 5 and p[-1] in ".!?:" or n >= 9:
                total += COST * s
        return total

    def verdict(self, text: str | None) -> str | None:
        """'placeholder', 'residue' or None."""
        if not text or not text.strip():
            return None
        return "placeholder" if self.placeholder(text) else "residue" if self.log_odds(text) > 0 else None


def fit_models(texts: list[str], trusted: Iterable[str], trusted_slots: Iterable[str]) -> Model:
    record = fit([words(x) for x in trusted], [words(x) for x in texts])
    slot = fit([s for x in trusted_slots for s in slots(x)], [s for x in texts for s in slots(x)], trust=1.0, mu=0.02, odds=0.0)
    return Model(record, slot)


def sample(docs: DataFrame, text_col: str, sample_rows: int, sample_chars: int) -> DataFrame:
    """(h, t): the `sample_rows` distinct texts with the smallest hash, of each at most `sample_chars` characters from a place drawn by the hash."""
    t = F.col(text_col)
    some = docs.filter(F.length(F.trim(t)) > 0).select(F.xxhash64(t).alias("h"), t.alias("t"))
    # the hashes first, so that only the texts of the sample are moved
    last = some.select("h").distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    start = F.pmod(F.col("h"), F.greatest(F.length("t") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    kept = some.filter(F.col("h") <= F.lit(last).cast("bigint")).groupBy("h").agg(F.min("t").alias("t"))
    return kept.select("h", F.substr("t", start, F.lit(sample_chars)).alias("t"))


def train(docs: DataFrame, text_col: str = "text", trusted: Iterable[str] | None = None, trusted_slots: Iterable[str] | None = None, sample_rows: int = 6000, sample_chars: int = 20000) -> Model:
    """Fits both models in one task of an executor, on a bounded sample."""
    known = (list(trusted or TRUSTED), list(trusted_slots or TRUSTED_SLOTS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        texts = pd.concat(rows).sort_values("h")["t"].tolist() if rows else []
        yield pd.DataFrame({"model": [pickle.dumps(fit_models(texts, *known))]})

    fitted = sample(docs, text_col, sample_rows, sample_chars).coalesce(1).mapInPandas(run, "model binary").first()
    return pickle.loads(fitted[0]) if fitted else fit_models([], *known)


def residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, verdict) of every record that is residue: 'placeholder' or 'residue'."""
    model = model or train(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            rows = [(i, v) for i, t in zip(b["i"].tolist(), b["t"].tolist()) if (v := m.verdict(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "verdict"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL").mapInPandas(score, f"doc_id {kind}, verdict string")


def content_only(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """The table without its residue records."""
    r = residue(docs, id_col, text_col, model).select(F.col("doc_id").alias("_rid")).distinct()
    return docs.join(r, docs[id_col] == r["_rid"], "left_anti")
