"""Area outlines and the zone of a point.

A zone (a zip, a place) is given by the vertices of its rings. A point belongs to
a zone when a ray to the right crosses its outline an odd number of times; left
and lower borders count as inside, right and upper ones do not, so neighbours
that share a border never both own it. Where zones overlap the smallest name wins.

The plane is cut into rectangular cells and every edge is listed in the cells whose
points it can matter for. Points and edges then meet by an equi-join on the cell.
Outlines of different size use different grids (levels): an outline is at most four
times as large as the others of its level, so it never covers more than a few columns,
and a point probes its cell on each level in use.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.lookups import BROADCAST_LIMIT_BYTES, measured_bytes
from wardline.session import stable

_CELL_SPAN = 2**31  # cell numbers stay below half of this in both directions
_EDGE = ("lo_x", "lo_y", "hi_x", "hi_y")


# ---------------------------------------------------------------- outlines

def ring_vertices(df: DataFrame, geometry: str = "the_geom", all_rings: bool = False) -> DataFrame:
    """One row per vertex with ``part``, ``ring``, ``seq``, ``longitude``, ``latitude``.

    By default the outer ring of the first polygon only; ``all_rings`` keeps every
    polygon and every hole, which is what a zone lookup needs.
    """
    others = [c for c in df.columns if c != geometry]
    polygons = F.col(f"{geometry}.coordinates")
    if all_rings:
        rings = (
            df.select(*others, F.posexplode(polygons).alias("part", "_rings"))
            .select(*others, "part", F.posexplode("_rings").alias("ring", "_ring"))
        )
    else:
        rings = df.select(
            *others, F.lit(0).alias("part"), F.lit(0).alias("ring"), F.get(F.get(polygons, F.lit(0)), F.lit(0)).alias("_ring")
        )
    return rings.select(*others, "part", "ring", F.posexplode("_ring").alias("seq", "_point")).select(
        *others,
        "part",
        "ring",
        "seq",
        F.get("_point", F.lit(0)).alias("longitude"),
        F.get("_point", F.lit(1)).alias("latitude"),
    )


def assemble_rings(vertices: DataFrame, zone: str) -> DataFrame:
    """Vertex rows back to one ordered point array per ring.

    A ring is one polygon outline of the feed, the same unit it was read in.
    """
    points = F.sort_array(F.collect_list(F.struct("seq", "longitude", "latitude")))
    return (
        vertices.groupBy(zone, "part", "ring")
        .agg(points.alias("_points"))
        .select(
            zone,
            "part",
            "ring",
            F.transform("_points", lambda p: F.struct(p["longitude"].alias("x"), p["latitude"].alias("y"))).alias("points"),
        )
    )


def outline_shape(vertices: DataFrame) -> Column:
    """What tells the outlines of one zone apart."""
    known = [name for name in ("outline_mark", "ingest_seq") if name in vertices.columns]
    return F.col(known[0]) if known else F.lit(0)


def ring_edges(vertices: DataFrame, zone: str) -> DataFrame:
    """Edges between neighbouring vertices, lower end first, level edges left out.

    A vertex starts the edge of its own number and ends the one before. Grouping
    by edge pairs them up with no ring held in one piece. Both neighbours of a
    shared border get the very same edge, hence the very same arithmetic.

    Several outlines may carry one zone name; ``ingest_seq``, where present, tells
    them apart as ``shape``, or ``outline_mark`` where there is one.
    """
    shape = outline_shape(vertices)
    point = F.struct(F.col("latitude").alias("y"), F.col("longitude").alias("x"))
    halves = vertices.select(
        F.col(zone).alias("zone"),
        shape.alias("shape"),
        "part",
        "ring",
        F.explode(
            F.array(
                F.struct(F.col("seq").alias("edge"), point.alias("p")),
                F.struct((F.col("seq") - 1).alias("edge"), point.alias("p")),
            )
        ).alias("h"),
    )
    pairs = (
        halves.filter(F.col("zone").isNotNull())
        .groupBy("zone", "shape", "part", "ring", "h.edge")
        .agg(F.min("h.p").alias("lo"), F.max("h.p").alias("hi"), F.count(F.lit(1)).alias("ends"))
        .filter(F.col("ends") == 2)
        .select("zone", "shape", "lo", "hi")
    )
    # A ring whose last vertex is not its first one is closed by an edge between the two.
    ends = (
        vertices.filter(F.col(zone).isNotNull())
        .groupBy(F.col(zone).alias("zone"), shape.alias("shape"), "part", "ring")
        .agg(F.min_by(point, "seq").alias("first"), F.max_by(point, "seq").alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("zone", "shape", F.least("first.y", "last.y").alias("low"), "first", "last")
    )
    first_lower = F.col("first.y") == F.col("low")
    closing = ends.select(
        "zone",
        "shape",
        F.when(first_lower, F.col("first")).otherwise(F.col("last")).alias("lo"),
        F.when(first_lower, F.col("last")).otherwise(F.col("first")).alias("hi"),
    )
    return pairs.unionByName(closing).filter(F.col("lo.y") < F.col("hi.y")).select(
        "zone",
        "shape",
        F.col("lo.x").alias("lo_x"),
        F.col("lo.y").alias("lo_y"),
        F.col("hi.x").alias("hi_x"),
        F.col("hi.y").alias("hi_y"),
    )


def _right_of(edge, x: Column, y: Column) -> Column:
    """Does the edge cross the ray that runs right from (x, y)?"""
    slope_x = edge["lo_x"] + (y - edge["lo_y"]) * (edge["hi_x"] - edge["lo_x"]) / (edge["hi_y"] - edge["lo_y"])
    left, right = F.least(edge["lo_x"], edge["hi_x"]), F.greatest(edge["lo_x"], edge["hi_x"])
    return (edge["lo_y"] <= y) & (y < edge["hi_y"]) & (x < F.greatest(left, F.least(slope_x, right)))


# ---------------------------------------------------------------- zone index

@dataclass(frozen=True)
class ZoneIndex:
    """Zone outlines cut into cells.

    ``levels`` maps the number of each level in use to the (width, height) of its cells.
    ``pieces`` has one row per level, cell, outline and edge that points of the cell must
    be tested against, plus one without an edge where an odd number of further edges
    lies to the right of the whole cell. ``directory``, the same with one row per
    cell, exists only where the pieces together stay below the broadcast limit.
    ``number`` and ``touched`` are those of an index that is kept as a table: how often it
    was brought up to date, and the ``number, level, cell`` that each time changed.
    """

    levels: Mapping[int, tuple[float, float]]
    pieces: DataFrame
    directory: DataFrame | None
    number: int = 0
    touched: DataFrame | None = None
    broadcast_limit: int = BROADCAST_LIMIT_BYTES


def _cell_number(value: Column, size: Column | float) -> Column:
    return F.floor(value / (F.lit(size) if isinstance(size, float) else size))


def _cell_key(column: Column, row: Column) -> Column:
    return column * F.lit(_CELL_SPAN) + row


def fitting_levels(extents: DataFrame) -> dict[int, tuple[float, float]]:
    """Cell width and height for the outlines of each level.

    A point is tested against the edges that share its cell row, so rows get
    narrower with the number of vertices: about eight vertices to a row. Every edge
    is listed once per column to its left, so there are about four columns to an outline.
    One row per level comes to the driver: as many as the sizes have powers of four.
    """
    means = extents.groupBy("level").agg(F.avg("extent").alias("extent"), F.avg("vertices").alias("vertices")).collect()
    levels = {}
    for row in means:
        extent = row["extent"] or 1.0
        levels[row["level"]] = (extent / 4, extent / max((row["vertices"] or 0) / 8, 4))
    return levels


def build_zone_index(
    vertices: DataFrame,
    zone: str,
    cell: tuple[float, float] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> ZoneIndex:
    """Cut the outlines into cells of the given (width, height), or of fitting ones.

    An edge of an outline gives pieces in proportion to the columns to its left and the
    rows it spans. Its outline is no more than a few times wider than the mean of its level,
    and the edges of a ring together span about as many rows as it has vertices: the
    pieces grow with the vertices, however different the outlines are.
    """
    extents = outline_extents(vertices, zone)
    if cell:
        extents = extents.withColumn("level", F.lit(0))
    levels = {0: cell} if cell else fitting_levels(extents)
    if not levels:
        levels = {0: (1.0, 1.0)}
    pieces, bytes_bound = cut_pieces(vertices, zone, extents, levels)
    if bytes_bound <= broadcast_limit:
        return ZoneIndex(levels, pieces, stable(cell_directory(pieces)), broadcast_limit=broadcast_limit)
    return ZoneIndex(levels, stable(pieces), None, broadcast_limit=broadcast_limit)


def outline_extents(vertices: DataFrame, zone: str) -> DataFrame:
    """``zone, shape, outline_left, extent, vertices, level`` of every outline."""
    extents = vertices.groupBy(F.col(zone).alias("zone"), outline_shape(vertices).alias("shape")).agg(
        F.min("longitude").alias("outline_left"),
        ((F.max("longitude") - F.min("longitude") + F.max("latitude") - F.min("latitude")) / 2).alias("extent"),
        F.count(F.lit(1)).alias("vertices"),
    )
    size = F.when(F.col("extent") > 0, F.floor(F.log(4.0, "extent"))).otherwise(F.lit(0))
    return extents.withColumn("level", F.coalesce(size, F.lit(0)).cast("int"))


def cut_pieces(
    vertices: DataFrame, zone: str, extents: DataFrame, levels: Mapping[int, tuple[float, float]]
) -> tuple[DataFrame, int]:
    """The pieces of the outlines on the grids of their levels, and a bound of their bytes."""

    def per_level(n: int) -> Column:
        sizes = [F.when(F.col("level") == level, F.lit(float(cells[n]))) for level, cells in levels.items()]
        return F.coalesce(*sizes)

    left, right = F.least("lo_x", "hi_x"), F.greatest("lo_x", "hi_x")
    # Written once: the size check and the cutting both start from here.
    whole_edges = stable(ring_edges(vertices, zone).join(extents.select("zone", "shape", "outline_left", "level"), ["zone", "shape"]))
    edges = (
        whole_edges.withColumns({"width": per_level(0), "height": per_level(1)})
        .withColumns(
            {
                "low_row": _cell_number(F.col("lo_y"), F.col("height")),
                "high_row": _cell_number(F.col("hi_y"), F.col("height")),
                "first_col": _cell_number(F.col("outline_left"), F.col("width")),
                "left_col": _cell_number(left, F.col("width")),
                "last_col": _cell_number(right, F.col("width")),
            }
        )
    )
    cells = (F.col("high_row") - F.col("low_row") + 1) * (F.col("last_col") - F.col("first_col") + 1)
    bytes_bound = edges.agg(F.sum(cells * (F.octet_length("zone") + F.lit(64)))).first()[0] or 0

    # An edge that spans the full height of the cell row and lies right of the cell
    # is crossed by every point of the cell: no test needed, so its ends are dropped.
    whole = (
        (F.col("low_row") < F.col("row"))
        & (F.col("row") < F.col("high_row"))
        & (F.col("col") < F.col("left_col"))
    )
    listed = (
        edges.withColumn("row", F.explode(F.sequence("low_row", "high_row")))
        .withColumn("col", F.explode(F.sequence("first_col", "last_col")))
        .select(
            "level",
            _cell_key(F.col("col"), F.col("row")).alias("cell"),
            "zone",
            "shape",
            *[F.when(~whole, F.col(c)).alias(c) for c in _EDGE],
        )
    )
    # Equal pieces of one outline cancel in pairs: only an odd count changes the answer.
    pieces = (
        listed.groupBy("level", "cell", "zone", "shape", *_EDGE)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") % 2 == 1)
        .drop("n")
    )
    return pieces, bytes_bound


def _point_cell(cells: tuple[float, float], x: Column, y: Column) -> Column:
    """Cell of a point; NULL for a missing, non-finite or absurdly far one."""
    width, height = map(float, cells)
    bound = _CELL_SPAN // 4
    usable = (F.abs(x) < F.lit(width * bound)) & (F.abs(y) < F.lit(height * bound))
    return F.when(usable, _cell_key(_cell_number(x, width), _cell_number(y, height)))


def cell_directory(pieces: DataFrame) -> DataFrame:
    """One row per cell: its candidate outlines in name order with the edges to test.

    Most cells lie wholly inside one zone: ``owner`` is the first zone that holds all of the
    cell, and only candidates that come before it need a test. Only built where all pieces
    stay below the broadcast limit, which bounds every array.
    """
    edge = F.struct(*_EDGE)
    has_edge = F.col("lo_x").isNotNull()
    per_outline = pieces.groupBy("level", "cell", "zone", "shape").agg(
        F.count(F.when(~has_edge, 1)).cast("int").alias("always"),
        F.collect_list(F.when(has_edge, edge)).alias("edges"),
    )
    covers = (F.size("edges") == 0) & (F.col("always") % 2 == 1)
    cells = per_outline.groupBy("level", "cell").agg(
        F.min(F.when(covers, F.col("zone"))).alias("owner"),
        F.sort_array(F.collect_list(F.when(F.size("edges") > 0, F.struct("zone", "always", "edges")))).alias("candidates"),
    )
    tested = F.filter("candidates", lambda c: F.col("owner").isNull() | (c["zone"] < F.col("owner")))
    return cells.select("level", "cell", "owner", tested.alias("candidates"))


def _holds(x: Column, y: Column):
    """Test whether a candidate outline holds the point."""

    def test(candidate: Column) -> Column:
        crossings = F.aggregate(
            candidate["edges"],
            candidate["always"],
            lambda n, edge: n + F.when(_right_of(edge, x, y), 1).otherwise(0),
        )
        return crossings % 2 == 1

    return test


def _locate_in_place(df: DataFrame, index: ZoneIndex, points: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Small index: every row finds its cell's candidates by a map-side join, nothing is shuffled."""
    for out, (lon, lat) in points.items():
        x, y = F.col(lon), F.col(lat)
        found = []
        for level, cells in index.levels.items():
            cell, answer = f"_cell{len(found)}", f"_zone{len(found)}"
            side = index.directory.filter(F.col("level") == level).drop("level").withColumnRenamed("cell", cell)
            df = df.withColumn(cell, _point_cell(cells, x, y)).join(F.broadcast(side), cell, "left")
            tested = F.get(F.filter("candidates", _holds(x, y)), F.lit(0))["zone"]
            first = F.when(F.size("candidates") > 0, F.coalesce(tested, F.col("owner"))).otherwise(F.col("owner"))
            df = df.withColumn(answer, first).drop(cell, "owner", "candidates")
            found.append(answer)
        df = df.withColumn(out, F.least(*found) if len(found) > 1 else F.col(found[0])).drop(*found)
    return df


def probed_cells(points: DataFrame, index: ZoneIndex) -> DataFrame:
    """``lon, lat`` rows with each ``level, cell`` that their answer depends on."""
    probes = F.array(
        *[
            F.struct(F.lit(level).alias("level"), _point_cell(cells, F.col("lon"), F.col("lat")).alias("cell"))
            for level, cells in index.levels.items()
        ]
    )
    keyed = points.withColumn("_probe", F.explode(probes)).select(*points.columns, "_probe.level", "_probe.cell")
    return keyed.filter(F.col("cell").isNotNull())


def probed_index(points: DataFrame, index: ZoneIndex) -> ZoneIndex:
    """The index without the cells that none of the ``lon, lat`` rows lies in, with a directory where that is small enough.

    Answers stay the same. The cells are made distinct on the map side, so what is shuffled of the points is at most a few
    bytes for each cell and task.
    """
    cells = probed_cells(points, index).select("level", "cell").distinct()
    pieces = stable(index.pieces.join(cells, ["level", "cell"], "left_semi"))
    size = pieces.agg(F.sum(F.octet_length("zone") + F.lit(64))).first()[0] or 0
    directory = stable(cell_directory(pieces)) if size <= index.broadcast_limit else None
    return replace(index, pieces=pieces, directory=directory)


def zone_of_points(points: DataFrame, index: ZoneIndex) -> DataFrame:
    """``lon, lat`` rows (distinct) to ``lon, lat, zone`` for those inside one.

    Edges meet points on level and cell; the join emits true crossings only, which are
    counted per point and outline on the map side. Of a small index the pieces are sent to
    the points; else both are shuffled, and adaptive execution splits a crowded cell.
    """
    keyed = probed_cells(points, index)
    pieces = index.pieces.withColumnsRenamed({"cell": "piece_cell", "level": "piece_level"})
    if index.directory is not None:
        pieces = F.broadcast(pieces)
    crossing = F.col("lo_x").isNull() | _right_of({c: F.col(c) for c in _EDGE}, F.col("lon"), F.col("lat"))
    same_cell = (F.col("cell") == F.col("piece_cell")) & (F.col("level") == F.col("piece_level"))
    return (
        keyed.join(pieces, same_cell & crossing)
        .groupBy("lon", "lat", "zone", "shape")
        .agg(F.count(F.lit(1)).alias("crossings"))
        .filter(F.col("crossings") % 2 == 1)
        .groupBy("lon", "lat")
        .agg(F.min("zone").alias("zone"))
    )


def _every_point(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    ends = F.explode(F.array(*[F.struct(F.col(x).alias("lon"), F.col(y).alias("lat")) for x, y in pairs])).alias("p")
    return df.select(ends).select("p.lon", "p.lat").filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())


def distinct_points(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Distinct (lon, lat) over several coordinate pairs of the same rows, in one pass."""
    return _every_point(df, *pairs).distinct()


def attach_zones(df: DataFrame, lookup: DataFrame, points: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Left join a (lon, lat, zone) lookup back on each coordinate pair.

    Rows without a point match nothing. They get a key made from their own content,
    which deals them out over all partitions instead of meeting in the one for NULL.
    The keys of all pairs are made before the first join, so that columns nobody asks for
    are shuffled by none of them. A lookup that is not sent out whole is built into a hash
    table by partition: it has one row for each coordinate, and the rows need no sorting.
    """
    lookup = F.broadcast(lookup) if measured_bytes(lookup) <= BROADCAST_LIMIT_BYTES else lookup.hint("shuffle_hash")
    content, keys = F.xxhash64(*df.columns).cast("double"), {}
    for n, (lon, lat) in enumerate(points.values()):
        missing = F.col(lon).isNull() | F.col(lat).isNull()
        keys[f"_x{n}"] = F.when(missing, content).otherwise(F.col(lon))
        keys[f"_y{n}"] = F.when(missing, F.lit(float("inf"))).otherwise(F.col(lat))
    df = df.withColumns(keys)
    for n, out in enumerate(points):
        side = lookup.select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), F.col("zone").alias(out))
        joined = df.join(side, (F.col(f"_x{n}") == F.col("_lon")) & (F.col(f"_y{n}") == F.col("_lat")), "left")
        df = joined.drop(f"_x{n}", f"_y{n}", "_lon", "_lat")
    return df


def locate(df: DataFrame, index: ZoneIndex, points: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add one zone column per coordinate pair; NULL where no zone holds the point.

    ``points`` maps the new column to its (longitude, latitude) columns. Of an index that is too large
    to send out, the cells with points may still be small enough; only if not are rows shuffled.
    """
    if index.directory is None:
        index = probed_index(_every_point(df, *points.values()), index)
    if index.directory is not None:
        return _locate_in_place(df, index, points)
    found = stable(zone_of_points(distinct_points(df, *points.values()), index))
    return attach_zones(df, found, points)
