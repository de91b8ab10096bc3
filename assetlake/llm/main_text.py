"""Main text of web pages: a tree-structured graphical model over the nodes of a page.

Every element and every text leaf is main text or not. What a node looks like gives its own potential, and each pair of
parent and child has one for their labels. Messages passed from the leaves up and from the page down (sum-product) give
each node's marginal; the weights maximise the likelihood of labelled pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import free_name
from assetlake.llm.html_tree import GROUPS, KINDS, LEAF, Page, labelled_pages, parse

#: Pages that the model learns from: written ones, and at most as many of the table, each of at most ``SAMPLE_BYTES``.
WRITTEN_PAGES = 400
SAMPLE_PAGES = 300
SAMPLE_BYTES = 64_000
SEED = 11
STEPS = 150
DECAY = 1e-3
#: Nodes whose marginals a task computes at once (whole pages).
NODES = 60_000

LENGTHS = (20, 60, 150, 400, 1500)
SHARES = (0.05, 0.3, 0.7)
PARTS = (0.1, 0.3, 0.6)
#: Own features: kind, purposes, text length and share of links for leaves and for elements, an element's part of all
#: text outside links, place, sentence ends.
WIDTH = len(KINDS) + len(GROUPS) + 2 * (len(LENGTHS) + 1 + len(SHARES) + 1) + len(PARTS) + 1 + 5 + 2
#: Kinds of edges, by the child: a leaf, an element that says it is the text, one that says it is something else, others.
EDGES = 4
TEXT = GROUPS.index("text")
SAYS_MAIN = [KINDS.index(k) for k in ("article", "main")]
SAYS_OTHER = [KINDS.index(k) for k in ("nav", "header", "footer", "aside", "form")]


@dataclass
class Forest:
    """Pages side by side: features per node, parents, and the nodes by depth."""

    features: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    levels: list[np.ndarray]
    main: np.ndarray
    starts: np.ndarray


def forest(pages: list[Page]) -> Forest:
    starts = np.cumsum([0] + [len(p.parent) for p in pages])
    n = int(starts[-1])
    parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, starts)])
    kind = np.concatenate([np.array(p.kind) for p in pages])
    end = np.concatenate([np.array(p.end) + s for p, s in zip(pages, starts)])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    size, links, ends = np.zeros(n), np.zeros(n), np.zeros(n, bool)
    purpose = np.zeros((n, len(GROUPS)), bool)
    for page, s in zip(pages, starts):
        for node, text in page.text.items():
            size[s + node], links[s + node] = len(text), page.links[node]
            ends[s + node] = text.rstrip()[-1:] in ".!?…\"»"
        for node, marks in enumerate(page.marks):
            if marks:
                purpose[s + node, list(marks)] = True
    total, linked = (np.concatenate([[0.0], np.cumsum(x)]) for x in (size, links))
    at = np.arange(n)
    whole, whole_links = total[end] - total[at], linked[end] - linked[at]
    first = np.repeat(starts[:-1], np.diff(starts))
    last = np.repeat(starts[1:], np.diff(starts))
    place = (total[at] - total[first]) / np.maximum(1, total[last] - total[first])
    leaf = kind == LEAF
    columns = [kind[:, None] == np.arange(len(KINDS)), purpose]
    for mine in (leaf, ~leaf):
        bucket = np.where(mine, np.searchsorted(LENGTHS, whole), -1)
        columns.append(bucket[:, None] == np.arange(len(LENGTHS) + 1))
        bucket = np.where(mine, np.searchsorted(SHARES, whole_links / np.maximum(1, whole)), -1)
        columns.append(bucket[:, None] == np.arange(len(SHARES) + 1))
    plain, all_plain = whole - whole_links, (total - linked)[last] - (total - linked)[first]
    bucket = np.where(leaf, -1, np.searchsorted(PARTS, plain / np.maximum(1, all_plain)))
    columns.append(bucket[:, None] == np.arange(len(PARTS) + 1))
    columns.append(np.minimum(4, (place * 5).astype(int))[:, None] == np.arange(5))
    columns.append(np.column_stack([leaf & ends, np.ones(n, bool)]))
    other = np.isin(kind, SAYS_OTHER) | np.delete(purpose, TEXT, axis=1).any(1)
    edge = np.select([leaf, other, np.isin(kind, SAYS_MAIN) | purpose[:, TEXT]], [0, 2, 1], 3)
    main = np.concatenate([np.array(p.main) for p in pages])
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    return Forest(np.concatenate(columns, axis=1), parent, edge, levels, main, starts)


def marginals(trees: Forest, own: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(main) per node, P(label of parent, label) per node, log of the partition sum) by sum-product.

    ``own`` has a row of two log potentials per node, ``pair`` a 2 x 2 table per kind of edge. A root's pair is zero.
    """
    up = own.copy()
    sent = np.zeros_like(own)
    for level in reversed(trees.levels[1:]):
        # Sum over the child's label (last axis) for each label of the parent.
        sent[level] = np.logaddexp.reduce(up[level][:, None, :] + pair[trees.edge[level]], axis=2)
        for label in (0, 1):
            up[:, label] += np.bincount(trees.parent[level], sent[level, label], len(up))
    roots = trees.levels[0]
    norm = np.logaddexp.reduce(up[roots], axis=1)
    belief = np.empty_like(own)
    belief[roots] = up[roots] - norm[:, None]
    joint = np.zeros((len(own), 2, 2))
    for level in trees.levels[1:]:
        above = belief[trees.parent[level]] - sent[level]
        both = above[:, :, None] + up[level][:, None, :] + pair[trees.edge[level]]
        joint[level] = np.exp(both)
        belief[level] = np.logaddexp.reduce(both, axis=1)
    return np.exp(belief[:, 1]), joint, float(norm.sum())


@dataclass
class Model:
    """Weights of the own features for "main", and log potentials of (parent's label, label) per kind of edge."""

    own: np.ndarray
    pair: np.ndarray

    def potentials(self, trees: Forest) -> np.ndarray:
        out = np.zeros((len(trees.features), 2))
        out[:, 1] = trees.features @ self.own
        return out

    def likelihood(self, trees: Forest, label: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean log likelihood per node of the labels, and its gradients by ``own`` and ``pair``."""
        own, n = self.potentials(trees), len(label)
        told, joint, norm = marginals(trees, own, self.pair)
        child = trees.parent >= 0
        child[trees.levels[0]] = False
        a, b, kind = label[trees.parent[child]].astype(int), label[child].astype(int), trees.edge[child]
        score = own[np.arange(n), label.astype(int)].sum() + self.pair[kind, a, b].sum() - norm
        by_own = trees.features.T.astype(float) @ (label - told)
        by_pair = np.zeros_like(self.pair)
        np.add.at(by_pair, (kind, a, b), 1)
        for k in range(EDGES):
            by_pair[k] -= joint[child][kind == k].sum(axis=0)
        return score / n, by_own / n, by_pair / n


def labels_of(trees: Forest, pages: list[Page]) -> np.ndarray:
    """Main or not: a leaf by its mark, an element if most of the text in it is main."""
    size = np.zeros(len(trees.parent))
    for page, s in zip(pages, trees.starts):
        for node, text in page.text.items():
            size[s + node] = len(text)
    end = np.concatenate([np.array(p.end) + s for p, s in zip(pages, trees.starts)])
    total, main = (np.concatenate([[0.0], np.cumsum(x)]) for x in (size, size * trees.main))
    at = np.arange(len(size))
    whole = total[end] - total[at]
    return np.where(whole > 0, 2 * (main[end] - main[at]) > whole, trees.main)


def fit(pages: list[Page], steps: int = STEPS, decay: float = DECAY) -> Model:
    """Weights by ascending the likelihood of the pages' labels (Adam steps on all pages, squared weights penalised)."""
    trees = forest(pages)
    label = labels_of(trees, pages)
    flat = np.zeros(WIDTH + 4 * EDGES)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        model = Model(flat[:WIDTH], flat[WIDTH:].reshape(EDGES, 2, 2))
        _, own, pair = model.likelihood(trees, label)
        slope = np.concatenate([own, pair.ravel()]) - decay * flat / 10
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        flat = flat + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model(flat[:WIDTH], flat[WIDTH:].reshape(EDGES, 2, 2))


def own_label(source: str) -> str | None:
    """The page with its only article or main element marked as main text, or None if it has not exactly one."""
    lower = source.lower()
    places = [(lower.find(f"<{tag}{after}"), tag) for tag in ("article", "main") for after in "> "]
    found = [(at, tag) for at, tag in places if at >= 0]
    if len(found) != 1 or lower.count("<" + found[0][1]) != 1:
        return None
    at, tag = found[0]
    return source[: at + 1 + len(tag)] + ' data-label="main"' + source[at + 1 + len(tag) :]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Model:
    """A model of ``WRITTEN_PAGES`` labelled pages and a sample of the table's pages that label themselves.

    Pages with exactly one article or main element, drawn by a hash of id and page, are labelled by it; a quarter of them is
    read with its name hidden, so that the model also learns what such text looks like. A table without such pages
    leaves the written ones.
    """
    page = F.col(f"`{html_col}`")
    name = F.concat_ws("/", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.crc32(F.encode(page, "UTF-8")))
    fits = page.isNotNull() & (F.octet_length(page) <= SAMPLE_BYTES) & page.rlike("(?i)<(article|main)[ >]")
    sample = pages.where(fits).select(page.alias("html"), F.xxhash64(F.lit(SEED), name).alias("h"))
    # The least hashes first, without the pages, so that tasks send numbers only; then the pages that have them.
    least = [r["h"] for r in sample.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    rows = sample.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html")).collect() if least else []
    rows.sort(key=lambda r: r["h"])
    marked = [m for m in (own_label(r["html"]) for r in rows) if m is not None]
    written = labelled_pages(WRITTEN_PAGES, SEED)
    return fit([parse(p, True) for p in written] + [parse(p, True, i % 4 == 0) for i, p in enumerate(marked)])


def main_texts(pages: list[Page], model: Model) -> list[str]:
    if not pages:
        return []
    trees = forest(pages)
    told, _, _ = marginals(trees, model.potentials(trees), model.pair)
    kept = told > 0.5
    return [p.words_of(kept[s:]) for p, s in zip(pages, trees.starts)]


def extract(pages: DataFrame, model: Model, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all by default, under whatever names), the main text and its number of code points.

    The new columns are ``text`` and ``n_chars``, with underscores in front where ``carry`` has these names. A null or
    empty page has an empty text. White space is Unicode's, so a no-break space becomes a space too.
    """
    carry = pages.columns if carry is None else carry
    taken = pages.select(*[F.col(f"`{c}`") for c in carry])
    names = [free_name(taken, "text"), free_name(taken, "n_chars")]
    told: list[Column] = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    read = pages.select(*told, F.col(f"`{html_col}`").alias("html"))
    schema = read.schema["html"].dataType
    kept = read.drop("html").schema.add("text", schema).add("n_chars", "long")
    width = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, waiting, nodes = [], [], 0
            for value in batch.column(width):
                waiting.append(parse(value.as_py() or ""))
                nodes += len(waiting[-1].parent)
                if nodes >= NODES:
                    texts += main_texts(waiting, model)
                    waiting, nodes = [], 0
            texts += main_texts(waiting, model)
            column = pa.array(texts, pa.string())
            sizes = pa.array([len(t) for t in texts], pa.int64())
            fields = [*batch.schema.names[:width], "text", "n_chars"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], column, sizes], fields)

    return read.mapInArrow(run, kept).toDF(*carry, *names)
