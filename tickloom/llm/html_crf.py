"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks: the text between two block-level tags, with the marks of its
ancestors (tags, roles, words of class and id) and features of the text. A chain over the blocks in
page order has two labels, article and other; Viterbi gives the best labelling, and the article's
blocks are the text.

Training pages label themselves: on a page with an ``article`` or ``main`` element, the blocks inside
are the article. So that the field does not lean on that element alone, each training page is also
seen with marks of its blocks hidden, and with boilerplate moved into the article under other marks
of boilerplate. Weights are drawn towards ``BELIEF``, what such marks mean in general, which is what
is left for marks that the training pages do not have. The fit sees at most ``max_pages`` pages, those
of least hash, and so has a fixed size; every page is parsed whole and decoded in its task.

Defined cases: a null or empty page has empty text; a page without blocks too; broken markup is read
as far as browsers would, roughly: what is left open ends with its parent, a head also where anything
else begins, and an embedded element without an end tag hides nothing; equal rows get equal texts;
without pages that label themselves the belief alone decides.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import sampled

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Text inside is never shown; it is skipped until the element ends, by its own end tag or with its parent.
SKIPPED = set("script style template title annotation annotation-xml".split())
#: What stands inside is left out where the element has its end tag; without one, only the start tag is.
EMBEDDED = set("noscript svg iframe object canvas".split())
IN_HEAD = set("title base link meta script style noscript template".split())
MATH = set("math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mspace mpadded mphantom semantics annotation annotation-xml".split())
INLINE = MATH | set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: A start tag of the key ends an open element of the value's tags.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
SCOPES = set("article aside body button div fieldset footer form header html main nav ol section table td th ul".split())

TAG_MARKS = {
    "article": "article", "main": "main", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side",
    "form": "form", "button": "form", "select": "form", "label": "form", "fieldset": "form", "textarea": "form", "dialog": "notice",
    "ul": "list", "ol": "list", "dl": "list", "table": "table", "blockquote": "quote", "figure": "figure", "address": "footer",
}
ROLE_MARKS = {
    "navigation": "nav", "menu": "nav", "menubar": "nav", "banner": "header", "contentinfo": "footer", "complementary": "side",
    "search": "form", "form": "form", "dialog": "notice", "alert": "notice", "alertdialog": "notice", "main": "main", "article": "article",
}
#: Words of class and id, by what they mark (fixed values; English, then German, French, Spanish). Words that as often
#: name a layout or a topic, such as column, text, more or tags, are left out.
WORD_MARKS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs dropdown skip navigationsleiste hauptmenue brotkrumen fil ariane migas menuprincipal",
    "header": "header masthead topbar banner branding logo toolbar kopfzeile kopfbereich entete cabecera encabezado",
    "footer": "footer foot copyright colophon legal imprint impressum fusszeile fussbereich pied mentions pie",
    "side": "sidebar side aside widget widgets rail related recommended recommendations trending popular seitenleiste randspalte laterale lateral verwandt similaires relacionados relacionadas",
    "advert": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion dfp werbung anzeige anzeigen reklame publicite pub publicidad anuncio anuncios patrocinado",
    "notice": "notice notices cookie cookies consent gdpr popup modal overlay alert warning banner disclaimer paywall hinweis hinweise einwilligung avis avertissement aviso avisos consentimiento",
    "form": "form login signin signup register search subscribe subscription newsletter contact anmeldung anmelden suche suchen kontakt formular formulaire connexion recherche formulario buscar busqueda suscripcion",
    "comments": "comment comments commentlist reply replies respond discussion disqus responses reviews kommentar kommentare leserkommentare diskussion commentaire commentaires reponses comentario comentarios respuestas",
    "share": "share sharing social tagcloud meta byline author bio rating toolbox print teilen autor auteur partage partager compartir",
    "content": "content article post entry story body main page inhalt artikel beitrag contenu billet contenido articulo entrada noticia",
}
#: Marks of class and id that an article inside, or the article's own element, does not take on: they name its surroundings.
AROUND = frozenset({"side", "share", "header", "form"})
WORDS = {word: mark for mark, words in WORD_MARKS.items() for word in words.split()}
OTHER_MARKS = ("nav", "header", "footer", "side", "advert", "notice", "form", "comments", "share", "hidden")

#: What a feature says of a block before any training: above zero for the article.
BELIEF = {
    "bias": -0.5, "article": 3.0, "main": 2.0, "content": 1.0, "list": -0.3, "table": 0.0, "quote": 0.3, "figure": 0.0,
    **{m: -9.0 for m in OTHER_MARKS}, "header": -6.0, "form": -6.0, "share": -5.0,
    "is_p": 1.0, "is_heading": 0.3, "is_item": -0.3, "words_0_3": -0.7, "words_4_11": 0.0, "words_12_": 1.0, "words_30_": 0.5,
    "links_half": -2.5, "links_some": -0.3, "sentence": 0.7, "rights": -2.5,
}
NAMES = list(BELIEF)
PLACE = {name: i for i, name in enumerate(NAMES)}
TRANSITION_BELIEF = np.array([[0.7, -0.7], [-0.7, 0.7]])
STRIPPED = re.compile(r"[^a-z]+")
RIGHTS = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|copyright", re.IGNORECASE)
SENTENCE = re.compile(r"[.!?…。][\"'»”)\]]*(?:\s|$)")


Marks = tuple[frozenset[str], frozenset[str]]


def _marks(tag: str, attributes: list[tuple[str, str | None]], inside: Marks) -> Marks:
    """Marks of what an element holds, given those around it: by tags and roles, and by words of class and id."""
    around, words_around = inside
    found = {TAG_MARKS[tag]} if tag in TAG_MARKS else set()
    words: set[str] = set()
    if tag == "header" and around & {"article", "main"}:
        found.clear()  # the heading of the article itself
    for name, value in attributes:
        value = (value or "").lower()
        if name == "role" and value in ROLE_MARKS:
            found.add(ROLE_MARKS[value])
        elif name in ("class", "id") and tag not in ("html", "body"):
            plain = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
            words.update(WORDS[w] for w in STRIPPED.split(plain) if w in WORDS)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            found.add("hidden")
    words |= words_around
    if found & {"article", "main"}:
        words -= AROUND
    return around | found, frozenset(words)


class _Blocks(HTMLParser):
    """Collects ``(text, marks)`` of the leaf blocks of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # tag, marks, whether text is skipped, number of blocks before
        self.open: list[tuple[str, Marks, bool, int]] = [("", (frozenset(), frozenset()), False, 0)]
        self.links = 0
        self.blocks: list[tuple[str, frozenset[str]]] = []
        self._reset_block()

    def _reset_block(self) -> None:
        self.parts: list[str] = []
        self.link_size = 0
        self.marks: frozenset[str] = frozenset()
        self.leaf = ""

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((text, self.marks | _text_features(text, self.leaf, self.link_size)))
            self._reset_block()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            if self.parts:
                self.parts.append(" ")
            return
        self._leave_head(tag)
        if tag in VOID:
            if tag not in INLINE:
                self.end_block()
            return
        if tag not in INLINE:
            self.end_block()
            if tag in CLOSES:
                self._close_one(CLOSES[tag], stop={"ul", "ol", "dl", "table", "select"})
            else:
                self._close_one({"p"}, stop=SCOPES)
        if tag == "a":
            self.links += 1
        _, marks, skipped, _ = self.open[-1]
        self.open.append((tag, _marks(tag, attrs, marks), skipped or tag in SKIPPED, len(self.blocks)))

    def _leave_head(self, tag: str) -> None:
        """Whatever no head can hold ends it."""
        if self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._pop_to(len(self.open) - 1)

    def _close_one(self, tags: set[str], stop: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                self._pop_to(i)
                return
            if self.open[i][0] in stop:
                return

    def _pop_to(self, size: int) -> None:
        self.links -= sum(tag == "a" for tag, *_ in self.open[size:])
        del self.open[size:]

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if tag in EMBEDDED:
                    del self.blocks[self.open[i][3] :]
                self._pop_to(i)
                return
            if tag in INLINE and self.open[i][0] in SCOPES:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "iframe", "path"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._leave_head("")
        if self.open[-1][2]:
            return
        if not self.parts:
            if data.isspace():
                return
            self.marks = self.open[-1][1][0] | self.open[-1][1][1]
            self.leaf = next((t for t, *_ in reversed(self.open) if t not in INLINE), "")
        self.parts.append(data)
        if self.links:
            self.link_size += len(data)


def _text_features(text: str, leaf: str, link_size: int) -> frozenset[str]:
    words = text.count(" ") + 1
    found = {"bias", "words_0_3" if words <= 3 else "words_4_11" if words <= 11 else "words_12_"}
    if words >= 30:
        found.add("words_30_")
    if link_size:
        found.add("links_half" if 2 * link_size > len(text) else "links_some")
    if SENTENCE.search(text):
        found.add("sentence")
    if len(text) < 400 and RIGHTS.search(text):
        found.add("rights")
    if leaf == "p":
        found.add("is_p")
    elif leaf in ("h1", "h2", "h3", "h4", "h5", "h6"):
        found.add("is_heading")
    elif leaf in ("li", "dd", "dt", "option"):
        found.add("is_item")
    return frozenset(found)


def leaf_blocks(html: str | None) -> list[tuple[str, frozenset[str]]]:
    """Text and features of the leaf blocks of a page, in page order."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.blocks


def _row(features: frozenset[str]) -> np.ndarray:
    row = np.zeros(len(NAMES))
    row[[PLACE[f] for f in features]] = 1.0
    return row


class Field:
    """Weights of the article label over the other one, and of the four transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray) -> None:
        self.weights, self.transitions = weights, transitions
        self.by_name = dict(zip(NAMES, weights.tolist()))

    def decode(self, blocks: list[frozenset[str]]) -> list[bool]:
        """Viterbi: the labelling of the chain with the largest score."""
        (oo, oa), (ao, aa) = self.transitions.tolist()
        other, article, back = 0.0, 0.0, []
        for i, features in enumerate(blocks):
            emit = sum(self.by_name[f] for f in features)
            if i:
                from_other = (other + oo >= article + ao, other + oa > article + aa)
                other, article = max(other + oo, article + ao), max(other + oa, article + aa)
                back.append(from_other)
            article += emit
        labels = [article > other]
        for to_other, to_article in reversed(back):
            labels.append(not (to_article if labels[-1] else to_other))
        return labels[::-1] if blocks else []


def _expectations(article: np.ndarray, mask: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains, from the scores of the article label: P(article) of each block, expected transition counts."""
    pages, length = article.shape
    emit = np.stack([np.zeros((pages, length)), article], axis=2)
    alpha, beta = np.zeros((pages, length, 2)), np.zeros((pages, length, 2))
    alpha[:, 0] = emit[:, 0]
    for t in range(1, length):
        step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + transitions, axis=1) + emit[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(transitions + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    article = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * mask
    pair = alpha[:, :-1, :, None] + transitions + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
    counts = (np.exp(np.minimum(pair, 0.0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
    return article, counts


Chain = tuple[list[frozenset[str]], list[int]]


def variants(blocks: list[frozenset[str]], labels: list[int], draw: np.random.Generator) -> list[Chain]:
    """The page itself, with marks hidden, and with boilerplate inside the article under other marks."""
    place = frozenset({"article", "main", "content"})
    found: list[Chain] = [(blocks, labels)]
    found.append(([b - place for b in blocks], labels))
    marks = frozenset(TAG_MARKS.values()) | frozenset(WORD_MARKS)
    found.append(([(b - place if y else b - marks) if draw.random() < 0.3 else b for b, y in zip(blocks, labels)], labels))
    inserted: list[tuple[frozenset[str], int]] = []
    others = [b for b, y in zip(blocks, labels) if not y] or blocks[:1]
    for b, y in zip(blocks, labels):
        inserted.append((b, y))
        if y and draw.random() < 0.25:
            source = others[draw.integers(len(others))] if draw.random() < 0.5 else b
            mark = OTHER_MARKS[draw.integers(len(OTHER_MARKS))]
            inserted.append(((source - marks) | (b & place) | {mark}, 0))
    found.append(([b for b, _ in inserted], [y for _, y in inserted]))
    return found


def fit(chains: list[Chain], rounds: int = 150, rate: float = 0.1, pull: float = 0.02) -> Field:
    """Adam steps on the mean log-likelihood, with a quadratic pull towards ``BELIEF``."""
    belief = np.array(list(BELIEF.values()))
    weights, transitions = belief.copy(), TRANSITION_BELIEF.copy()
    chains = [c for c in chains if c[0]]
    if not chains:
        return Field(weights, transitions)
    numbers: dict[frozenset[str], int] = {}
    padded, seen = [], np.zeros((2, 2))
    # chains of like length together, so that one long page does not stretch the others
    for _, group in itertools.groupby(sorted(chains, key=lambda c: len(c[0])), key=lambda c: len(c[0]).bit_length()):
        same = list(group)
        size = (len(same), len(same[-1][0]))
        at, y, mask = np.zeros(size, np.int32), np.zeros(size, int), np.zeros(size, bool)
        for i, (blocks, labels) in enumerate(same):
            at[i, : len(blocks)] = [numbers.setdefault(b, len(numbers)) for b in blocks]
            y[i, : len(blocks)], mask[i, : len(blocks)] = labels, True
        np.add.at(seen, (y[:, :-1][mask[:, 1:]], y[:, 1:][mask[:, 1:]]), 1)
        padded.append((at, y, mask))
    x = np.array([_row(b) for b in numbers])
    flat = np.concatenate([weights, transitions.ravel()])
    prior, first, second, cut = flat.copy(), np.zeros_like(flat), np.zeros_like(flat), len(weights)
    for t in range(1, rounds + 1):
        scores, missed, counts = x @ flat[:cut], np.zeros(len(x)), np.zeros((2, 2))
        for at, y, mask in padded:
            article, moves = _expectations(scores[at], mask, flat[cut:].reshape(2, 2))
            missed += np.bincount(at[mask], (y - article)[mask], len(x))
            counts += moves
        slope = np.concatenate([missed @ x, (seen - counts).ravel()]) / len(chains)
        slope -= pull * (flat - prior)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        flat = flat + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Field(flat[:cut], flat[cut:].reshape(2, 2))


def train(pages: DataFrame, html: str = "html", max_pages: int = 120) -> Field:
    """Fit on whole pages that label themselves."""
    content = F.col(f"`{html}`")
    labelled = pages.select(content.alias("html")).filter(content.rlike(r"(?i)<(article|main)[\s>]"))
    sample = sampled(labelled, F.col("html"), max_pages).collect()
    draw = np.random.default_rng(11)
    chains: list[Chain] = []
    for (page,) in sample:
        blocks = [features for _, features in leaf_blocks(page)]
        labels = [int(bool(b & {"article", "main"}) and not b & set(OTHER_MARKS)) for b in blocks]
        chains += variants(blocks, labels, draw)
    return fit(chains)


def main_text(html: Column, field: Field) -> Column:
    """The article's blocks of each page, joined by one space."""

    def extract(pages: pd.Series) -> pd.Series:
        texts = []
        for page in pages:
            blocks = leaf_blocks(page)
            chosen = field.decode([features for _, features in blocks])
            texts.append(" ".join(text for (text, _), keep in zip(blocks, chosen) if keep))
        return pd.Series(texts, dtype=object)

    extract.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return F.pandas_udf(extract, "string").asNondeterministic()(html)
