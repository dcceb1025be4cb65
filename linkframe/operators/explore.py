"""An explorer: a graph and the vertex one stands on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkframe.functions.names import vertex_text
from linkframe.operators.enumerate import number
from linkframe.operators.graph import Graph


@dataclass(frozen=True)
class Vertex:
    graph: Graph
    id: int
    label: str

    def outdegree(self) -> int:
        return self.graph.outdegree(self.id)

    def indegree(self) -> int:
        return self.graph.indegree(self.id)

    def successors(self) -> DataFrame:
        return self.graph.successors(self.id)

    def predecessors(self) -> DataFrame:
        return self.graph.predecessors(self.id)

    def __str__(self) -> str:
        return f"#{self.id}\t{self.label}"


def listing(vertices: DataFrame) -> DataFrame:
    """(pos, line): ``i: #id<tab>name`` of (id, name) rows, numbered from 0 by id."""
    rows = number(vertices, ["id", "name"], "pos")
    return rows.select(F.col("pos").cast("int").alias("pos"), F.format_string("%d: %s", "pos", vertex_text(F.col("id"), F.col("name"))).alias("line"))


class Explorer:
    def __init__(self, graph: Graph):
        self.graph, self.vertex = graph, None

    def get_vertex(self, v: int | str) -> Vertex | None:
        row = self.graph.vertex(v).head()
        return Vertex(self.graph, row["id"], row["name"]) if row else None

    def set_vertex(self, v: int | str) -> Vertex | None:
        self.vertex = self.get_vertex(v)
        return self.vertex

    cn = set_vertex

    def pwn(self) -> str:
        """The current vertex as text."""
        return str(self._here())

    def ls(self, v: int | str | None = None) -> DataFrame:
        """Listing of successors, of v or of the current vertex."""
        return listing(self.graph.successors(self._here().id if v is None else v))

    def sl(self, v: int | str | None = None) -> DataFrame:
        """Listing of predecessors."""
        return listing(self.graph.predecessors(self._here().id if v is None else v))

    def _here(self) -> Vertex:
        if self.vertex is None:
            raise LookupError("no vertex is set; use cn(id or label)")
        return self.vertex


def shortcuts(explorer: Explorer) -> dict:
    """Names for an interactive shell: ``globals().update(shortcuts(Explorer(graph)))``."""
    return {"g": explorer.graph, "e": explorer, **{n: getattr(explorer, n) for n in ("cn", "pwn", "ls", "sl")}}
