"""Delaunay triangulation of points with whole-number coordinates, by divide and conquer.

Only signs of whole-number determinants decide, so points on one line or one circle (the
rule on a grid) need no tolerance.  It runs inside a task, on the rim of one hole or the
points of one tile.
"""

from __future__ import annotations


def delaunay(points: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Triangles as indices into ``points``, counter-clockwise.  Points must be distinct;
    fewer than three, or points on one line, have no triangle.  Of several triangulations
    (four points on a circle) one is returned, the same for the same points in any order."""
    if len(points) < 3:
        return []
    order = sorted(range(len(points)), key=points.__getitem__)
    mesh = _Mesh([points[i] for i in order])
    mesh.build(0, len(order))
    return [(order[a], order[b], order[c]) for a, b, c in mesh.triangles()]


class _Mesh:
    """Directed edges; ``e ^ 1`` is the reverse of ``e``.  ``ccw`` and ``cw`` are the next
    edges round the same origin."""

    def __init__(self, points: list[tuple[int, int]]):
        self.points = points
        self.origin: list[int] = []
        self.ccw: list[int] = []
        self.cw: list[int] = []
        self.gone: list[bool] = []

    def edge(self, a: int, b: int) -> int:
        e = len(self.origin)
        self.origin += (a, b)
        self.ccw += (e, e + 1)
        self.cw += (e, e + 1)
        self.gone += (False, False)
        return e

    def splice(self, a: int, b: int) -> None:
        """Join two rings of edges round an origin, or cut one ring in two."""
        ccw, cw = self.ccw, self.cw
        na, nb = ccw[a], ccw[b]
        ccw[a], ccw[b] = nb, na
        cw[na], cw[nb] = b, a

    def link(self, a: int, b: int) -> int:
        """A new edge from the end of ``a`` to the origin of ``b``, with both on its left."""
        e = self.edge(self.origin[a ^ 1], self.origin[b])
        self.splice(e, self.cw[a ^ 1])
        self.splice(e ^ 1, b)
        return e

    def drop(self, e: int) -> None:
        self.splice(e, self.cw[e])
        self.splice(e ^ 1, self.cw[e ^ 1])
        self.gone[e] = self.gone[e ^ 1] = True

    def turn(self, a: int, b: int, c: int) -> int:
        """Positive where a, b, c run counter-clockwise, 0 on a line."""
        (ax, ay), (bx, by), (cx, cy) = self.points[a], self.points[b], self.points[c]
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

    def inside(self, a: int, b: int, c: int, d: int) -> bool:
        """Does ``d`` lie within the circle through a, b, c (counter-clockwise)?"""
        (dx, dy) = self.points[d]
        ax, ay = self.points[a][0] - dx, self.points[a][1] - dy
        bx, by = self.points[b][0] - dx, self.points[b][1] - dy
        cx, cy = self.points[c][0] - dx, self.points[c][1] - dy
        return (
            (ax * ax + ay * ay) * (bx * cy - by * cx)
            - (bx * bx + by * by) * (ax * cy - ay * cx)
            + (cx * cx + cy * cy) * (ax * by - ay * bx)
        ) > 0

    def right(self, p: int, e: int) -> bool:
        return self.turn(p, self.origin[e ^ 1], self.origin[e]) > 0

    def build(self, lo: int, hi: int) -> tuple[int, int]:
        """Triangulate points lo to hi (sorted).  Returns the hull's counter-clockwise edge
        out of the leftmost point and its clockwise edge out of the rightmost."""
        if hi - lo == 2:
            e = self.edge(lo, lo + 1)
            return e, e ^ 1
        if hi - lo == 3:
            a, b = self.edge(lo, lo + 1), self.edge(lo + 1, lo + 2)
            self.splice(a ^ 1, b)
            side = self.turn(lo, lo + 1, lo + 2)
            if side == 0:
                return a, b ^ 1
            c = self.link(b, a)
            return (a, b ^ 1) if side > 0 else (c ^ 1, c)
        mid = (lo + hi) // 2
        left_out, left_in = self.build(lo, mid)
        right_in, right_out = self.build(mid, hi)
        origin, ccw, cw = self.origin, self.ccw, self.cw
        while True:  # the lower common tangent
            if self.turn(origin[right_in], origin[left_in], origin[left_in ^ 1]) > 0:
                left_in = cw[left_in ^ 1]  # the next edge of the left hull
            elif self.right(origin[left_in], right_in):
                right_in = ccw[right_in ^ 1]
            else:
                break
        base = self.link(right_in ^ 1, left_in)
        if origin[left_in] == origin[left_out]:
            left_out = base ^ 1
        if origin[right_in] == origin[right_out]:
            right_out = base
        while True:  # sew upwards
            left, right = ccw[base ^ 1], cw[base]
            above = lambda e: self.right(origin[e ^ 1], base)  # noqa: E731, B023
            ends = origin[base ^ 1], origin[base]
            if above(left):
                while above(ccw[left]) and self.inside(*ends, origin[left ^ 1], origin[ccw[left] ^ 1]):
                    nxt = ccw[left]
                    self.drop(left)
                    left = nxt
            if above(right):
                while above(cw[right]) and self.inside(*ends, origin[right ^ 1], origin[cw[right] ^ 1]):
                    nxt = cw[right]
                    self.drop(right)
                    right = nxt
            if not above(left) and not above(right):
                return left_out, right_out
            if not above(left) or (above(right) and self.inside(origin[left ^ 1], origin[left], origin[right], origin[right ^ 1])):
                base = self.link(right, base ^ 1)
            else:
                base = self.link(base ^ 1, left ^ 1)

    def triangles(self):
        """Faces of three edges that run counter-clockwise, each from its smallest edge."""
        origin, cw, gone = self.origin, self.cw, self.gone
        for e in range(len(origin)):
            if not gone[e]:
                f = cw[e ^ 1]
                g = cw[f ^ 1]
                if e < f and e < g and cw[g ^ 1] == e and self.turn(origin[e], origin[f], origin[g]) > 0:
                    yield origin[e], origin[f], origin[g]
