"""Trees as tables: tips, common ancestors, leaf order."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TREE_NODES

_TOKEN = re.compile(r"\s*(?:'((?:[^']|'')*)'|([(),;:])|([^(),;:\s']+))")


def parse_newick(text: str) -> list[tuple[int, int | None, str | None, bool]]:
    """(node, parent, name, is_tip) in the order of the text, the root first; branch lengths and comments are skipped."""
    names: list[str | None] = [None]
    parents: list[int | None] = [None]
    inner = [False]
    at, after_colon = 0, False
    for quoted, mark, word in _TOKEN.findall(re.sub(r"\[[^]]*\]", "", text)):
        if mark in {"(", ","}:
            parent = at if mark == "(" else parents[at]
            if parent is None:
                raise ValueError("a tree has one root")
            names.append(None), parents.append(parent), inner.append(False)
            inner[parent] = True
            at, after_colon = len(names) - 1, False
        elif mark == ")":
            if parents[at] is None:
                raise ValueError("a bracket closes that none opened")
            at, after_colon = parents[at], False
        elif mark == ":":
            after_colon = True
        elif mark == ";":
            break
        elif not after_colon:
            names[at] = quoted.replace("''", "'") if quoted else word
    return [(k, parents[k], names[k], not inner[k]) for k in range(len(names))]


def leaf_order(nodes: list[tuple], ladderize: bool = True) -> dict[int, int]:
    """Place of each tip; ``ladderize`` puts smaller subtrees first, equal ones as they stand."""
    children: dict[int, list[int]] = {}
    for node, parent, *_ in nodes:
        if parent is not None:
            children.setdefault(parent, []).append(node)
    size = dict.fromkeys((n[0] for n in nodes), 0)
    for node, parent, _, is_tip in reversed(nodes):
        size[node] += is_tip
        if parent is not None:
            size[parent] += size[node]
    out, stack = {}, [nodes[0][0]]
    while stack:
        node = stack.pop()
        below = sorted(children.get(node, ()), key=size.__getitem__) if ladderize else children.get(node, [])
        if not below:
            out[node] = len(out)
        stack += reversed(below)
    return out


def tree_nodes(trees: DataFrame, ladderize: bool = True) -> DataFrame:
    """The node table of ``trees(hmm, newick)``; ids count from 0 at the root in the order of the text."""

    def run(batches):
        for batch in batches:
            rows = []
            for hmm, text in zip(batch["hmm"], batch["newick"], strict=True):
                nodes = parse_newick(text)
                place = leaf_order(nodes, ladderize)
                rows += [(hmm, n, p, name, tip, place.get(n)) for n, p, name, tip in nodes]
            out = pd.DataFrame(rows, columns=TREE_NODES.names)
            for c in ("parent_id", "leaf_ord"):
                out[c] = out[c].astype("Int32")
            yield out

    return trees.select("hmm", "newick").mapInPandas(run, TREE_NODES)


def tips(nodes: DataFrame) -> DataFrame:
    return nodes.where("is_tip").select("hmm", F.col("name").alias("tip"), "leaf_ord")


def common_ancestors(nodes: DataFrame, clades: DataFrame, shown: int = 10) -> DataFrame:
    """(hmm, clade, status, detail, mrca_id, mrca_name): the last common ancestor of each clade's tips in each tree.

    ``missing_tips`` lists tips that a tree lacks, ``no_tips`` marks a clade without any; neither keeps other clades from
    being answered. A tree is one task's work; clades are joined to it, not broadcast.
    """
    there = tips(nodes).select(F.col("hmm").alias("hmm"), "tip").distinct()
    # tips meet the trees that have them by name; what a tree lacks is the clade without them
    asked = clades.select("clade", "tip", "ord")
    met = asked.join(there, "tip").groupBy("hmm", "clade").agg(F.collect_set("tip").alias("tips"))
    whole = asked.groupBy("clade").agg(F.array_sort(F.collect_list(F.struct("ord", "tip"))).alias("all"))
    families = nodes.select(F.col("hmm").alias("hmm")).distinct()
    # one row a family and clade is the result's own size
    groups = families.join(F.broadcast(whole.select("clade")), F.lit(True)).join(met, ["hmm", "clade"], "left").join(whole, "clade")
    found = F.coalesce("tips", F.array().cast("array<string>"))
    gone = F.transform(F.slice(F.filter("all", lambda x: ~F.array_contains(found, x["tip"])), 1, shown), lambda x: x["tip"])
    groups = groups.select("hmm", "clade", F.array_join(gone, ",").alias("missing"), found.alias("tips"))

    def solve(key, tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        parent = dict(zip(tree["node_id"], tree["parent_id"], strict=True))
        name = dict(zip(tree["node_id"], tree["name"], strict=True))
        node = {n: k for k, n, t in zip(tree["node_id"], tree["name"], tree["is_tip"], strict=True) if t}

        def line(k):
            out = [k]
            while pd.notna(parent[out[-1]]):
                out.append(int(parent[out[-1]]))
            return out[::-1]

        rows = []
        for clade, missing, own in zip(asked["clade"], asked["missing"], asked["tips"], strict=True):
            if missing or not len(own):
                rows.append((key[0], clade, "missing_tips" if missing else "no_tips", missing or None, None, None))
                continue
            shared = line(node[own[0]])
            for tip in own[1:]:
                other = line(node[tip])
                shared = [a for a, b in zip(shared, other) if a == b]
            rows.append((key[0], clade, "ok", None, shared[-1], name[shared[-1]]))
        out = pd.DataFrame(rows, columns=["hmm", "clade", "status", "detail", "mrca_id", "mrca_name"])
        out["mrca_id"] = out["mrca_id"].astype("Int32")
        return out

    schema = "hmm string, clade string, status string, detail string, mrca_id int, mrca_name string"
    return nodes.groupBy("hmm").cogroup(groups.groupBy("hmm")).applyInPandas(solve, schema)
