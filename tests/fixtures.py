"""Small hand-made base tables."""

from waymark.schema import NODE, RELATION, WAY
from waymark.sources.tables import OsmTables

CODES = {"n": NODE, "w": WAY, "r": RELATION}


class Builder:
    """Collects nodes, ways and relations, then turns them into base tables."""

    def __init__(self, spark):
        self.spark = spark
        self.nodes, self.ways, self.way_nodes, self.relations, self.members = [], [], [], [], []
        self._points = {}

    def node(self, id, x=0, y=0, tags=None):
        self.nodes.append((id, x, y, tags))
        return self

    def way(self, id, points, tags=None, is_area=False):
        """A way over grid points; equal points share a node."""
        self.ways.append((id, is_area, tags))
        for seq, point in enumerate(points):
            if point not in self._points:
                self._points[point] = 1_000_000 + len(self._points)
                self.nodes.append((self._points[point], *point, None))
            self.way_nodes.append((id, seq, self._points[point]))
        return self

    def way_of_nodes(self, id, node_ids, tags=None, is_area=False):
        self.ways.append((id, is_area, tags))
        self.way_nodes += [(id, seq, node) for seq, node in enumerate(node_ids)]
        return self

    def relation(self, id, members=(), tags=None, is_area=False):
        """Members as (letter, id, role)."""
        self.relations.append((id, is_area, tags))
        self.members += [(id, seq, CODES[k], m, role) for seq, (k, m, role) in enumerate(members)]
        return self

    def area(self, id, *rings):
        """An area relation over (role, points) rings, each a way of its own."""
        first = id * 100_000
        for n, (_, points) in enumerate(rings):
            self.way(first + n, points)
        return self.relation(id, [("w", first + n, role) for n, (role, _) in enumerate(rings)],
                             is_area=True)

    def tables(self, seq_span=4096):
        frames = {
            "nodes": (self.nodes, "id long, x int, y int, tags map<string,string>"),
            "ways": (self.ways, "id long, is_area boolean, tags map<string,string>"),
            "way_nodes": (self.way_nodes, "way_id long, seq long, node_id long"),
            "relations": (self.relations, "id long, is_area boolean, tags map<string,string>"),
            "relation_members": (self.members, "relation_id long, seq long, member_type int, "
                                               "member_id long, role string"),
        }
        made = {n: self.spark.createDataFrame(rows, ddl) for n, (rows, ddl) in frames.items()}
        return OsmTables(self.spark, {n: (lambda df=df: df) for n, df in made.items()}, seq_span)


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
