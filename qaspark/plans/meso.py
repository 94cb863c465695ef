"""Meso level: which tags go together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from qaspark.fixed_values import MIN_EDGE_WEIGHT, NETWORK_TOP_N, SITE_TOP_N
from qaspark.operators import graph, payload
from qaspark.operators.centrality import betweenness_centrality
from qaspark.operators.communities import communities
from qaspark.session import write_through


@dataclass
class Meso:
    nodes: DataFrame
    edges: DataFrame
    summary: DataFrame
    documents: DataFrame


def run_meso(
    questions: DataFrame,
    min_weight: int = MIN_EDGE_WEIGHT,
    top_n: int = NETWORK_TOP_N,
    site_top_n: int = SITE_TOP_N,
    weighted: bool = True,
    keep: list[str] | None = None,
) -> Meso:
    """Tag graph of every language with communities and centrality, and the trimmed documents."""
    nodes, edges = graph.cooccurrence_graph(questions, min_weight, top_n)
    nodes = graph.network_nodes(
        nodes, communities(edges), graph.degree_centrality(edges), betweenness_centrality(edges, weighted)
    )
    nodes = write_through(nodes, "nodes")
    best, inner = graph.trim_network(nodes, edges, site_top_n, keep=keep)
    return Meso(nodes, edges, graph.network_summary(nodes, edges), payload.network_payload(best, inner))
