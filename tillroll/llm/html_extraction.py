"""Main text of web pages: gradient-boosted trees over DOM nodes.

A page is a tree of block elements with their texts as leaves
(:mod:`tillroll.llm.dom`).  Each node has subtree density (words for each
element, links, punctuation, shares of the page and of its parent), its depth
and place, statistics of its siblings, and the tokens of its tag, class, id
and role and of the elements above it.  Boosted trees give the odds that a leaf
is main text, or that an element holds some.

Decoding is hierarchical: of all choices in which a chosen node's parent is
chosen too, the one with the largest sum of log odds is taken.  So an advert
inside an article goes although the article stays, and no paragraph of a
rejected sidebar can stay.

The trees are fitted on a bounded sample of the pages themselves
(``SAMPLE_PAGES``, each of at most ``SAMPLE_CHARS``): on those that name their
main part (article, main), and on the sample's texts set in ``LAYOUT_PAGES``
other layouts (:mod:`tillroll.llm.page_layouts`).  All else covers all pages.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.classifier import Trees, fit_trees
from tillroll.llm.common import map_arrow
from tillroll.llm.dom import ELEMENT, LEAF, Forest, Tree
from tillroll.llm.page_layouts import Layout

SAMPLE_PAGES, SAMPLE_CHARS = 120, 200_000
LAYOUT_PAGES, TREES, DEPTH = 1000, 80, 5
TOKENS, TOKEN_NODES = 1000, 8  # scored tokens: at most so many, each seen on so many nodes or more
NODES = 50_000  # nodes scored at once
PROSE_WORDS = 12  # texts of the sample with fewer words are menu entries


@dataclass
class Model:
    """The trees, and the scores of tokens: of a node that has one, and of texts below such a node."""

    trees: Trees
    own: dict[str, float]
    above: dict[str, float]

    def gains(self, forest: Forest) -> np.ndarray:
        """Log odds of every node."""
        odds = np.empty(len(forest))
        rows = features(forest, self.own, self.above)
        for at in range(0, len(rows), NODES):
            p = np.clip(self.trees.score(rows[at:at + NODES]), 1e-4, 1 - 1e-4)
            odds[at:at + NODES] = np.log(p / (1 - p))
        return odds


def features(forest: Forest, own: dict[str, float], above: dict[str, float]) -> np.ndarray:
    return np.concatenate([forest.statistics(), forest.token_scores(own, above)], axis=1)


def token_odds(pairs: list[tuple[str, float]], tokens: int) -> dict[str, float]:
    """Log odds, against all, that a node with a token is labelled 1; of the
    ``tokens`` most frequent ones with ``TOKEN_NODES`` nodes or more."""
    many, good = Counter(t for t, _ in pairs), Counter(t for t, y in pairs if y)
    base = (sum(good.values()) + 1) / (sum(many.values()) - sum(good.values()) + 1)
    held = sorted(many, key=lambda t: (-many[t], t))[:tokens]
    return {t: float(np.log((good[t] + 1) / (many[t] - good[t] + 1) / base)) for t in held if many[t] >= TOKEN_NODES}


def marked(tag, attrs, above):
    """The mark of a training page: of the element, else of the one above it."""
    return next((int(v) for k, v in attrs if k == "data-main"), above)


def named(tag, attrs, above):
    """What the semantic elements of a page say of their texts."""
    if tag in ("article", "main"):
        return 1
    if tag in ("nav", "footer", "aside", "form") or tag == "header" and above != 1:
        return 0
    return above


def _labels(forest: Forest, trees: list[Tree]) -> np.ndarray:
    """Whether a leaf is marked as main text, or an element has such a leaf."""
    leaf = (forest.total[:, LEAF] > 0) & (forest.total[:, ELEMENT] == 0)
    mark = np.array([x == 1 for t in trees for x in t.label], bool) & leaf
    running = np.concatenate([[0], np.cumsum(mark)])
    return (running[forest.end] > running[:-1]).astype(float)


def fit_pages(pages: list[str], layouts: int = LAYOUT_PAGES, tokens: int = TOKENS, seed: int = 1) -> Model:
    """Fit on the given pages and ``layouts`` made ones; the result depends on these alone."""
    trees = [Tree(p, named) for p in pages]
    trees = [t for t in trees if 1 in t.label]
    prose, shorts = [], []
    for t in trees or [Tree(p, named) for p in pages]:
        for leaf, text in t.texts.items():
            (prose if len(text.split()) >= PROSE_WORDS else shorts).append(text)
    draw = Layout(seed, prose, shorts)
    trees += [Tree(draw.page(), marked) for _ in range(layouts)]
    forest = Forest(trees)
    labels = _labels(forest, trees)
    use = forest.total[:, LEAF] > 0  # nodes without text don't matter
    leaf = use & (forest.total[:, ELEMENT] == 0)
    own = token_odds([(t, labels[i]) for i in np.flatnonzero(use) for t in forest.tokens[i]], tokens)
    below = []
    for i in np.flatnonzero(leaf).tolist():
        seen, up = set(), forest.parent[i]
        while up >= 0:
            seen |= forest.tokens[up]
            up = forest.parent[up]
        below += [(t, labels[i]) for t in seen]
    above = token_odds(below, tokens)
    rows = features(forest, own, above)
    return Model(fit_trees(rows[use], labels[use], trees=TREES, depth=DEPTH), own, above)


def sample(pages: DataFrame, html_col: str = "html", rows: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``rows`` different pages of at most ``chars`` characters, by a hash
    of the page: the same on every run.

    Of a large table only rows whose hash falls below a cut are looked at, about
    ``4 * rows`` of them, so that little is sent to the driver however many
    tasks there are.
    """
    html = pages[html_col]
    found = pages.select(html.alias("html"), F.xxhash64(html).alias("h")).where(html.isNotNull() & (F.length(html) <= chars))
    many = pages.count()
    if many > 4 * rows:
        found = found.where(F.pmod("h", F.lit(1 << 40)) < int(4 * rows / many * (1 << 40)))
    return [r["html"] for r in found.dropDuplicates(["html"]).orderBy("h", "html").limit(rows).collect()]


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    trees = [Tree(p) for p in pages]
    forest = Forest(trees)
    chosen = forest.decode(model.gains(forest)) if len(forest) else np.zeros(0, bool)
    out = []
    for t, at in zip(trees, forest.first.tolist()):
        out.append(" ".join(text for leaf, text in t.texts.items() if chosen[at + leaf] and text))
    return out


def extract(pages: DataFrame, model: Model, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The main text of every whole page: the columns ``keep``, ``text`` and ``n_chars``.

    White space inside a block is one space, blocks are joined in page order by
    one space.  One row per input row and no shuffle: a null or empty page, or
    one without main text, has an empty text; nulls in the other columns and
    repeated rows stay as they are; an empty table gives no rows; other columns
    are not read.  Runs no job; :func:`fit` does.
    """
    chosen = pages.select(*[pages[c].alias(f"k{i}") for i, c in enumerate(keep)], pages[html_col].alias("html"))
    types = dict(chosen.dtypes)

    def run(batches):
        for batch in batches:
            texts = main_texts([h or "" for h in batch.column(len(keep)).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(texts, pa.string())],
                                             names=[*batch.schema.names[:len(keep)], "text"])

    schema = ", ".join([*[f"k{i} {types[f'k{i}']}" for i in range(len(keep))], "text string"])
    out = map_arrow(chosen, run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text",
                      F.char_length("text").cast("long").alias("n_chars"))


def fit(pages: DataFrame, html_col: str = "html") -> Model:
    """A model for these pages, fitted on their bounded sample."""
    return fit_pages(sample(pages, html_col))
