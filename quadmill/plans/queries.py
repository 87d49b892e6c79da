"""One registered query per operator, with the SQL that must give the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import color, crs, general, geodesy, grid, linear, times
from ..operators import binning, jobs, pyramid, raster, terrain, vector
from .fixtures import table, view, with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
c, lit = F.col, F.lit
R6 = lambda x: F.round(x, 6)


def query(name: str, sql: str | None = None):
    def keep(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(sql)
        return f

    return keep


# SQL fragments of the coordinate model ----------------------------------------------

MX, MY = "(radians(lng)/pi())", "(ln(tan(pi()/4+radians(lat)/2))/pi())"


def px_sql(x: str, lod: int) -> str:
    last = (256 << lod) - 1
    return f"cast(greatest(least(floor(({x}+1)/2*{last}+0.5),{last}),0) as bigint)"


def py_sql(y: str, lod: int) -> str:
    return f"({(256 << lod) - 1} - {px_sql(y, lod)})"


def points_sql(lod: int) -> str:
    return f"q_p as (select *, {px_sql(MX, lod)} as px, {py_sql(MY, lod)} as py from geo_points), q_t as (select *, px >> 8 as tx, py >> 8 as ty from q_p)"


def qk_sql(x: str, y: str, lod) -> str:
    return f"lpad(cast(cast(bin({x}) as hugeint)+2*cast(bin({y}) as hugeint) as varchar), {lod}, '0')"


def points(spark, sf, lod: int) -> DataFrame:
    return grid.with_tiles(view(spark, sf, "geo_points"), lod)


# Coordinates ---------------------------------------------------------------------------


@query("mercator_forward", f"select l_orderkey, l_linenumber, round({MX}, 6) as x, round({MY}, 6) as y, round(ln(tan(pi()/4+radians(lat)/2)*pow((1-{grid.ECCENTRICITY}*sin(radians(lat)))/(1+{grid.ECCENTRICITY}*sin(radians(lat))), {grid.ECCENTRICITY / 2}))/pi(), 6) as y_ellipsoid from geo_points")
def mercator_forward(spark, sf):
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", R6(grid.mercator_x("lng")).alias("x"), R6(grid.mercator_y("lat")).alias("y"), R6(grid.mercator_y("lat", grid.ECCENTRICITY)).alias("y_ellipsoid"))


@query("mercator_reverse", "select l_orderkey, l_linenumber, round(lng, 6) as lng_back, round(lat, 6) as lat_back, round(lat, 6) as lat_ellipsoid from geo_points")
def mercator_reverse(spark, sf):
    p = view(spark, sf, "geo_points").withColumn("x", grid.mercator_x("lng")).withColumn("y", grid.mercator_y("lat")).withColumn("ye", grid.mercator_y("lat", grid.ECCENTRICITY))
    return p.select("l_orderkey", "l_linenumber", R6(grid.longitude("x")).alias("lng_back"), R6(grid.latitude("y")).alias("lat_back"), R6(grid.latitude("ye", grid.ECCENTRICITY)).alias("lat_ellipsoid"))


@query("ground_resolution", f"select c_custkey, lod, round(cos(radians(lat))*2*pi()*6378137.0/(256*pow(2,lod)), 6) as metres from (select c_custkey, cast(c_custkey%170 as double)-85 as lat, cast(c_custkey%20 as integer) as lod from customer)")
def ground_resolution(spark, sf):
    t = table(spark, sf, "customer").select("c_custkey", ((c("c_custkey") % 170).cast("double") - 85).alias("lat"), (c("c_custkey") % 20).cast("int").alias("lod"))
    return t.select("c_custkey", "lod", R6(grid.ground_resolution("lat", c("lod"))).alias("metres"))


@query("point_to_tile", f"{points_sql(10)} select l_orderkey, l_linenumber, px, py, tx, ty from q_t")
def point_to_tile(spark, sf):
    return points(spark, sf, 10).select("l_orderkey", "l_linenumber", "px", "py", "tx", "ty")


@query("tile_quadkey", f"{points_sql(16)} select l_orderkey, l_linenumber, {qk_sql('tx', 'ty', 16)} as quadkey from q_t")
def tile_quadkey(spark, sf):
    return points(spark, sf, 16).select("l_orderkey", "l_linenumber", grid.quadkey("tx", "ty", 16).alias("quadkey"))


@query("quadkey_decode", f"{points_sql(12)} select distinct {qk_sql('tx', 'ty', 12)} as quadkey, tx, ty, {qk_sql('tx >> 1', 'ty >> 1', 11)} as parent, cast(tx%2 + 2*(ty%2) as integer) as child from q_t")
def quadkey_decode(spark, sf):
    q = points(spark, sf, 12).select(grid.quadkey("tx", "ty", 12).alias("quadkey")).distinct()
    return q.select("quadkey", grid.quadkey_x("quadkey").alias("tx"), grid.quadkey_y("quadkey").alias("ty"), grid.quadkey_parent("quadkey").alias("parent"), grid.quadkey_digit("quadkey").alias("child"))


@query("quadkey_range", f"{points_sql(8)} select l_orderkey, l_linenumber, {qk_sql('tx', 'ty', 8)} as quadkey from q_t where tx between 37 and 90 and ty between 50 and 101")
def quadkey_range(spark, sf):
    q = points(spark, sf, 8).select("l_orderkey", "l_linenumber", grid.quadkey("tx", "ty", 8).alias("quadkey"))
    return q.where(grid.in_extent("quadkey", 37, 50, 90, 101, 8))


@query("tile_bbox", "select lod, tx, ty, tx*2/pow(2.0,lod)-1 as x0, 1-ty*2/pow(2.0,lod) as y0, (tx+1)*2/pow(2.0,lod)-1 as x1, 1-(ty+1)*2/pow(2.0,lod) as y1 from tiles")
def tile_bbox(spark, sf):
    return view(spark, sf, "tiles").select("lod", "tx", "ty", *[b.alias(n) for b, n in zip(grid.tile_bbox("tx", "ty", "lod"), ("x0", "y0", "x1", "y1"))])


@query("tile_path", "select lod, tx, ty, '/layer/' || lod || '/' || tx || '/' || ty || '.png' as path from tiles")
def tile_path(spark, sf):
    return view(spark, sf, "tiles").select("lod", "tx", "ty", grid.tile_path("/layer/", "lod", "tx", "ty", ".png").alias("path"))


@query("octocode", "select l_orderkey, l_linenumber, lpad(cast(cast(bin(i) as hugeint)+2*cast(bin(j) as hugeint)+4*cast(bin(k) as hugeint) as varchar), 4, '0') as code, k*256+j*16+i as packed, i as back_i, j as back_j, k as back_k, k as unpacked_k from cloud")
def octocode(spark, sf):
    t = view(spark, sf, "cloud").withColumn("code", grid.octocode("i", "j", "k", 4)).withColumn("packed", grid.octree_index("i", "j", "k", 4))
    back = [grid.octocode_axis("code", a).alias(f"back_{n}") for a, n in enumerate("ijk")]
    return t.select("l_orderkey", "l_linenumber", "code", "packed", *back, grid.octree_unpack("packed", 4)[2].alias("unpacked_k"))


@query("google_projection", f"select l_orderkey, l_linenumber, cast(floor(131072 + lng*({262144 / 360!r}) + 0.5) as bigint) as gx, cast(floor(131072 - ln((1+f)/(1-f))*0.5*({262144 / (2 * math.pi)!r}) + 0.5) as bigint) as gy from (select *, greatest(least(sin(radians(lat)), 0.9999), -0.9999) as f from geo_points)")
def google_projection(spark, sf):
    x, y = grid.render_pixel("lng", "lat", 10)
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", x.cast("bigint").alias("gx"), y.cast("bigint").alias("gy"))


_ECEF = f"(select *, {geodesy.RADIUS!r}/sqrt(1-{geodesy.E2!r}*sin(radians(lat))*sin(radians(lat))) as n, elev_c/100.0 as h from geo_points)"


@query("ecef", f"select l_orderkey, l_linenumber, round((n+h)*cos(radians(lat))*cos(radians(lng)), 3)+0.0::double as x, round((n+h)*cos(radians(lat))*sin(radians(lng)), 3)+0.0::double as y, round((n*(1-{geodesy.E2!r})+h)*sin(radians(lat)), 3)+0.0::double as z from {_ECEF}")
def ecef(spark, sf):
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", *[(F.round(v, 3) + 0.0).alias(n) for v, n in zip(geodesy.ecef("lng", "lat", c("elev_c") / 100.0), "xyz")])


@query("geodetic_inverse", "select l_orderkey, l_linenumber, case when abs(lng) = 180 then 180.0 else round(lng, 6) end as lng_back, round(lat, 6) as lat_back from geo_points")
def geodetic_inverse(spark, sf):
    p = view(spark, sf, "geo_points")
    p = p.select("l_orderkey", "l_linenumber", *[v.alias(n) for v, n in zip(geodesy.ecef("lng", "lat", c("elev_c") / 100.0), "xyz")])
    lng, lat, _ = geodesy.geodetic("x", "y", "z")
    return p.select("l_orderkey", "l_linenumber", F.when(F.abs(R6(lng)) == 180, 180.0).otherwise(R6(lng)).alias("lng_back"), R6(lat).alias("lat_back"))


@query("local_frame", "select l_orderkey, l_linenumber, " + ", ".join(f"round({r[0]!r}*x + ({r[1]!r})*y + ({r[2]!r})*z + ({r[3]!r}), 3) as u{k}" for k, r in enumerate(geodesy.cube_frame(7.6, 45.0, 500.0).tolist())) + f" from (select *, (n+h)*cos(radians(lat))*cos(radians(lng)) as x, (n+h)*cos(radians(lat))*sin(radians(lng)) as y, (n*(1-{geodesy.E2!r})+h)*sin(radians(lat)) as z from {_ECEF})")
def local_frame(spark, sf):
    p = view(spark, sf, "geo_points")
    p = p.select("l_orderkey", "l_linenumber", *[v.alias(n) for v, n in zip(geodesy.ecef("lng", "lat", c("elev_c") / 100.0), "xyz")])
    return p.select("l_orderkey", "l_linenumber", *[F.round(v, 3).alias(f"u{k}") for k, v in enumerate(geodesy.to_cube(geodesy.cube_frame(7.6, 45.0, 500.0), "x", "y", "z"))])


@query("dms", "select l_orderkey, l_linenumber, case when lat < 0 then -1 else 1 end as sign, cast(floor(t/3600000) as integer) as deg, cast(floor(t/60000) as integer) % 60 as mins, (t % 60000)/1000.0 as secs from (select *, floor(abs(lat)*3600000+0.5) as t from geo_points)")
def dms(spark, sf):
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", *[v.alias(n) for v, n in zip(geodesy.to_dms("lat"), ("sign", "deg", "mins", "secs"))])


@query("distance_azimuth", f"select l_orderkey, l_linenumber, round({2 * geodesy.RADIUS!r}*asin(sqrt(least(1.0, pow(sin((radians(lat)-radians(45.0))/2),2)+cos(radians(45.0))*cos(radians(lat))*pow(sin(radians(lng-7.6)/2),2)))), 2) as metres, round(case when d < 0 then d+360.0 else d end, 5) as bearing from (select *, degrees(atan2(sin(radians(lng-7.6))*cos(radians(lat)), cos(radians(45.0))*sin(radians(lat))-sin(radians(45.0))*cos(radians(lat))*cos(radians(lng-7.6)))) as d from geo_points)")
def distance_azimuth(spark, sf):
    a = (lit(7.6), lit(45.0), "lng", "lat")
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", F.round(geodesy.great_circle(*a), 2).alias("metres"), F.round(geodesy.azimuth(*a), 5).alias("bearing"))


_AFFINE = "(select c_custkey, cast(c_custkey%100 as double) as a0, 2.0::double+c_nationkey as a1, 0.5::double as a2, cast(c_custkey%37 as double) as a3, 0.25::double as a4, -3.0::double-c_nationkey as a5 from customer)"


@query("affine_inverse", f"select c_custkey, round((a2*a3-a0*a5)/d, 9)+0.0::double as i0, round(a5/d, 9)+0.0::double as i1, round(-a2/d, 9)+0.0::double as i2, round((a0*a4-a1*a3)/d, 9)+0.0::double as i3, round(-a4/d, 9)+0.0::double as i4, round(a1/d, 9)+0.0::double as i5, a0+a1*10.0::double+a2*20.0::double as x, a3+a4*10.0::double+a5*20.0::double as y from (select *, a1*a5-a2*a4 as d from {_AFFINE})")
def affine(spark, sf):
    t = table(spark, sf, "customer").selectExpr("c_custkey", "cast(c_custkey%100 as double) as a0", "2.0D+c_nationkey as a1", "0.5D as a2", "cast(c_custkey%37 as double) as a3", "0.25D as a4", "-3.0D-c_nationkey as a5")
    a = [c(f"a{k}") for k in range(6)]
    x, y = grid.affine_apply(a, lit(10.0), lit(20.0))
    return t.select("c_custkey", *[(F.round(v, 9) + 0.0).alias(f"i{k}") for k, v in enumerate(grid.affine_inverse(a))], x.alias("x"), y.alias("y"))


# Extents and jobs ------------------------------------------------------------------------


@query("extent_bbox", "q_b as (select min(lng) as lng0, min(lat) as lat0, max(lng) as lng1, max(lat) as lat1 from geo_points) " + " union all ".join(f"select {lod} as lod, {px_sql('lng0/180', lod)} >> 8 as x0, {py_sql('(ln(tan(pi()/4+radians(lat1)/2))/pi())', lod)} >> 8 as y0, {px_sql('lng1/180', lod)} >> 8 as x1, {py_sql('(ln(tan(pi()/4+radians(lat0)/2))/pi())', lod)} >> 8 as y1 from q_b" for lod in range(1, 23)))
def extent_bbox(spark, sf):
    b = binning.bounds(view(spark, sf, "geo_points"), "lng", "lat")
    each = b.withColumn("lod", F.explode(F.sequence(lit(1), lit(22))))
    ext = grid.box_tiles("lng_min", "lat_min", "lng_max", "lat_max", c("lod"))
    return each.select("lod", *[v.alias(n) for v, n in zip(ext, ("x0", "y0", "x1", "y1"))])


@query("cloud_extent", "select min(i) as i_min, max(i) as i_max, min(j) as j_min, max(j) as j_max, min(k) as k_min, max(k) as k_max, count(*) as n from cloud")
def cloud_extent(spark, sf):
    return binning.bounds(view(spark, sf, "cloud"), "i", "j", "k")


_REC = " ".join(f"when v/{1 << (l + 1)} < p and p < v/{1 << l} then {l}" for l in range(19, -1, -1))


@query("lod_recommend", f"select n_nationkey, case {_REC.replace('v', 'v/22')} else 0 end as elevation_lod, case {_REC.replace('v', 'v/256')} else 0 end as image_lod from (select n_nationkey, n_nationkey*1.7+0.5 as p, cos(radians(n_nationkey*3.0-30))*2*pi()*6378137.0 as v from nation)")
def lod_recommend(spark, sf):
    t = table(spark, sf, "nation").selectExpr("n_nationkey", "n_nationkey*1.7D+0.5D as p", "n_nationkey*3.0D-30 as lat")
    return t.select("n_nationkey", grid.recommended_lod("p", "lat", "elevation").alias("elevation_lod"), grid.recommended_lod("p", "lat", "image").alias("image_lod"))


@query("border_bbox", "select ds, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from (select ds, 10+2.0::double*px+0.5::double*py as x, 90-0.25::double*px-3.0::double*py as y from (select c_nationkey as ds, x as px, y as py from (select distinct c_nationkey from customer), unnest(range(0, 41)) as a(x), unnest(range(0, 31)) as b(y) where x in (0, 40) or y in (0, 30))) group by ds")
def border_bbox(spark, sf):
    ds = table(spark, sf, "customer").select(c("c_nationkey").alias("ds")).distinct()
    walk = ds.withColumn("px", F.explode(F.sequence(lit(0), lit(40)))).withColumn("py", F.explode(F.when(c("px").isin(0, 40), F.sequence(lit(0), lit(30))).otherwise(F.array(lit(0), lit(30)))))
    x, y = grid.affine_apply([10.0, 2.0, 0.5, 90.0, -0.25, -3.0], "px", "py")
    p = walk.select("ds", x.alias("x"), y.alias("y"))
    return p.groupBy("ds").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


@query("tile_jobs", "select cast(l as integer) as lod, x as tx, y as ty from (select * from unnest(range(1, 10)) as t(l)), lateral (select unnest(range(37 >> (9-l), (90 >> (9-l)) + 1)) as x), lateral (select unnest(range(50 >> (9-l), (101 >> (9-l)) + 1)) as y)".replace("(9-l)", "cast(9-l as integer)"))
def tile_jobs(spark, sf):
    return jobs.layer_tiles(spark, 37, 50, 90, 101, 9)


_BOX = (-120.5, 20.25, 64.75, 71.5)


@query("render_jobs", " union all ".join(f"select {z} as lod, x as tx, y as ty from unnest(range({b[0]}, {b[2] + 2})) as a(x), unnest(range({b[1]}, {b[3] + 2})) as b(y) where x < {1 << z} and y < {1 << z}" for z in range(0, 8) for b in [grid.box_tiles_py(*_BOX, z)]))
def render_jobs(spark, sf):
    return jobs.render_jobs(spark, _BOX, range(0, 8))


@query("hillshade_jobs", " union all ".join(f"select {z} as lod, x as tx, y as ty from unnest(range({e[0] + 1}, {e[2]})) as a(x), unnest(range({e[1] + 1}, {e[3]})) as b(y)" for z, e in [(3, (4, 6, 11, 12)), (4, (9, 12, 22, 25)), (5, (18, 24, 45, 51)), (6, (36, 48, 91, 103))]))
def hillshade_jobs(spark, sf):
    return jobs.shade_jobs(spark, (9, 12, 22, 25), 4, 3, 6)


@query("expire_jobs", "select distinct cast(z as integer) as lod, x as tx, y as ty from (select 3 + c_nationkey%5 as z, (c_custkey*7919)%8 as x, (c_custkey + c_nationkey*3)%8 as y from customer)")
def expire_jobs(spark, sf):
    from ..sources.text import expire_list

    lines = view(spark, sf, "tiles").select(F.concat_ws("/", "lod", "tx", "ty").alias("value"))
    blank = lines.limit(1).select(lit("").alias("value"))
    return jobs.valid(expire_list(lines.union(blank))).distinct()


@query("skip_existing", "q_j as (select cast(l as integer) as lod, x as tx, y as ty from unnest(range(3, 8)) as t(l), unnest(range(0, 8)) as a(x), unnest(range(0, 8)) as b(y)) select lod, tx, ty from q_j where not exists (select 1 from tiles t where t.lod = q_j.lod and t.tx = q_j.tx and t.ty = q_j.ty)")
def skip_existing(spark, sf):
    want = spark.range(3, 8).select(c("id").cast("int").alias("lod"), lit(0).cast("bigint").alias("x0"), lit(0).cast("bigint").alias("y0"), lit(7).cast("bigint").alias("x1"), lit(7).cast("bigint").alias("y1"))
    return jobs.missing(jobs.expand(want).select("lod", "tx", "ty"), view(spark, sf, "tiles"))


@query("nearest_ancestor", "q_a as (select t.lod, t.tx, t.ty, min(u) as up from (select 9 as lod, (c_custkey*31)%512 as tx, (c_custkey*17)%512 as ty from customer group by all) t, unnest(range(0, 10)) as r(u) where exists (select 1 from tiles e where e.lod = t.lod - u and e.tx = t.tx >> cast(u as integer) and e.ty = t.ty >> cast(u as integer)) group by t.lod, t.tx, t.ty) select lod, tx, ty, cast(up as integer) as up, tx/pow(2.0,up) - floor(tx/pow(2.0,up)) as sub_x, ty/pow(2.0,up) - floor(ty/pow(2.0,up)) as sub_y from q_a")
def nearest_ancestor(spark, sf):
    want = table(spark, sf, "customer").select(lit(9).alias("lod"), (c("c_custkey") * 31 % 512).alias("tx"), (c("c_custkey") * 17 % 512).alias("ty")).distinct()
    return jobs.nearest_ancestor(want, view(spark, sf, "tiles"))


_DS = "(select s_suppkey as ds, (s_suppkey*7)%90 as x0, (s_suppkey*13)%80 as y0, (s_suppkey*7)%90 + s_suppkey%9 as x1, (s_suppkey*13)%80 + s_suppkey%7 as y1 from supplier)"


def datasets(spark, sf):
    return table(spark, sf, "supplier").selectExpr("s_suppkey as ds", "(s_suppkey*7)%90 as x0", "(s_suppkey*13)%80 as y0", "(s_suppkey*7)%90 + s_suppkey%9 as x1", "(s_suppkey*13)%80 + s_suppkey%7 as y1")


@query("dataset_tiles", f"select ds, x as tx, y as ty from {_DS} d, lateral (select unnest(range(greatest(x0, 20), least(x1, 70) + 1)) as x), lateral (select unnest(range(greatest(y0, 10), least(y1, 60) + 1)) as y) where x0 <= 70 and x1 >= 20 and y0 <= 60 and y1 >= 10")
def dataset_tiles(spark, sf):
    layer = [lit(v).cast("bigint").alias(n) for n, v in (("lx0", 20), ("ly0", 10), ("lx1", 70), ("ly1", 60))]
    d = datasets(spark, sf).select("*", *layer)
    d = d.where(binning.overlaps(["x0", "y0", "x1", "y1"], ["lx0", "ly0", "lx1", "ly1"]))
    ext = binning.clipped(["x0", "y0", "x1", "y1"], ["lx0", "ly0", "lx1", "ly1"])
    return jobs.expand(d.select("ds", *[v.alias(n) for v, n in zip(ext, ("x0", "y0", "x1", "y1"))])).select("ds", "tx", "ty")


# Filters, bins, points ---------------------------------------------------------------------


@query("nodata_filter", "select l_orderkey, l_linenumber, elev_c from geo_points where elev_c <> 1234500 and elev_c between -8000 and 1200000 and elev_c % 11 <> 0 and elev_c/100.0 <= 12000")
def nodata_filter(spark, sf):
    p = view(spark, sf, "geo_points").withColumn("elevation", c("elev_c") / 100.0).where("elev_c % 11 <> 0")
    return binning.valid_elevation(p, nodata=12345.0).select("l_orderkey", "l_linenumber", "elev_c")


@query("clip_layer", f"{points_sql(6)} select l_orderkey, l_linenumber, tx, ty from q_t where lng > -100.5 and lng < 80.25 and lat > -40 and lat < 66.6 and tx between 16 and 44 and ty between 15 and 38")
def clip_layer(spark, sf):
    p = points(spark, sf, 6).where(binning.inside("lng", "lat", -100.5, -40, 80.25, 66.6))
    return binning.interior_tiles(p, 15, 14, 45, 39).select("l_orderkey", "l_linenumber", "tx", "ty")


@query("bin_tiles", f"{points_sql(5)} select tx, ty, count(*) as n, cast(sum(elev_c) as bigint) as total, cast(sum(elev_c) as double)/count(*) as mean, min(elev_c) as low, max(elev_c) as high from q_t group by tx, ty")
def bin_tiles(spark, sf):
    return binning.tile_stats(points(spark, sf, 5), "elev_c")


@query("bin_offset", "q_x as (select cast(floor((lng/180.0+1)/0.0625) as bigint) as tx, 31-cast(floor((lat/90.0+1)/0.0625) as bigint) as ty, elev_c from geo_points where lng < 180 and lat < 90) select tx, ty, count(*) as n from q_x where tx between 3 and 28 and ty between 3 and 28 group by tx, ty")
def bin_offset(spark, sf):
    p = view(spark, sf, "geo_points").select(F.floor((c("lng") / 180.0 + 1) / 0.0625).cast("bigint").alias("tx"), (31 - F.floor((c("lat") / 90.0 + 1) / 0.0625)).cast("bigint").alias("ty"))
    return p.where(c("tx").between(3, 28) & c("ty").between(3, 28)).groupBy("tx", "ty").agg(F.count("*").alias("n"))


@query("bin_voxels", "select i, j, k, count(*) as n, cast(sum(r) as double)/count(*) as mean_r, cast(sum(intensity) as double)/count(*) as mean_intensity from cloud group by i, j, k")
def bin_voxels(spark, sf):
    return binning.voxel_stats(view(spark, sf, "cloud"), ["i", "j", "k"], ["r", "intensity"])


@query("voxel_mean", "select i>>1 as i, j>>1 as j, k>>1 as k, count(*) as n, cast(sum(r) as double)/count(*) as mean_r, cast(sum(g) as double)/count(*) as mean_g, cast(sum(b) as double)/count(*) as mean_b, cast(sum(intensity) as double)/count(*) as mean_intensity from cloud group by 1, 2, 3")
def voxel_mean(spark, sf):
    up = view(spark, sf, "cloud").select(*[F.shiftright(n, 1).alias(n) for n in "ijk"], "r", "g", "b", "intensity")
    return binning.voxel_stats(up, ["i", "j", "k"], ["r", "g", "b", "intensity"])


@query("voxel_index", "select distinct k*256+j*16+i as voxel from cloud")
def voxel_index(spark, sf):
    return view(spark, sf, "cloud").select(grid.octree_index("i", "j", "k", 4).alias("voxel")).distinct().orderBy("voxel")


@query("voxel_text", "select concat_ws(',', printf('%.3f', ((cast(i as double)+0.5)/16-0.5)*5000), printf('%.3f', ((cast(j as double)+0.5)/16-0.5)*5000), printf('%.3f', ((cast(k as double)+0.5)/16-0.5)*5000), r, g, b, '1', '') as line from (select i, j, k, max(r) as r, max(g) as g, max(b) as b from cloud group by i, j, k)")
def voxel_text(spark, sf):
    v = view(spark, sf, "cloud").groupBy("i", "j", "k").agg(*[F.max(n).alias(n) for n in "rgb"])
    place = [F.format_string("%.3f", ((c(n).cast("double") + 0.5) / 16 - 0.5) * 5000) for n in "ijk"]
    return v.select(F.concat_ws(",", *place, *[c(n).cast("string") for n in "rgb"], lit("1"), lit("")).alias("line"))


@query("cloud_convert", "select l_orderkey, l_linenumber, i || ',' || j || ',' || k || ',' || printf('%.3f', r/255.0) || ',' || printf('%.3f', g/255.0) || ',' || printf('%.3f', b/255.0) || ',1,' as line from cloud")
def cloud_convert(spark, sf):
    from ..sources.text import cloud_points
    from ..sinks.text import converted

    t = view(spark, sf, "cloud")
    lines = t.select("l_orderkey", "l_linenumber", F.concat_ws(" ", "i", "j", "k", "intensity", "r", "g", "b").alias("value"))
    return converted(cloud_points(lines, ["l_orderkey", "l_linenumber"])).select("l_orderkey", "l_linenumber", "line")


@query("parse_cloud", "select l_orderkey, l_linenumber, cast(i as double) as x, cast(j as double) as y, cast(k as double) as elevation, case when m in (1, 3) then cast(intensity as integer) else -1 end as intensity, case when m >= 2 then cast(r as integer) else 255 end as r, case when m >= 2 then cast(g as integer) else 255 end as g, case when m >= 2 then cast(b as integer) else 255 end as b from (select *, l_orderkey % 5 as m from cloud) where m < 4")
def parse_cloud(spark, sf):
    from ..sources.text import cloud_points

    m, parts = c("l_orderkey") % 5, lambda *n: F.concat_ws(";", *n)
    text = F.when(m == 0, F.concat_ws(" ", "i", "j", "k")).when(m == 1, F.concat_ws(",", "i", "j", "k", "intensity")).when(m == 2, F.concat_ws("\t", "i", "j", "k", "r", "g", "b")).when(m == 3, parts("i", "j", "k", "intensity", "r", "g", "b")).otherwise(parts("i", "j"))
    found = cloud_points(view(spark, sf, "cloud").select("l_orderkey", "l_linenumber", text.alias("value")), ["l_orderkey", "l_linenumber"])
    return found.withColumn("intensity", F.coalesce("intensity", lit(-1)))


@query("parse_elevation", "select l_orderkey, l_linenumber, lng as x, lat as y, elev_c/100.0 as elevation from geo_points where l_orderkey % 9 <> 4")
def parse_elevation(spark, sf):
    from ..sources.text import elevation_points

    text = F.when(c("l_orderkey") % 9 == 4, lit("1.0 bad")).otherwise(F.concat_ws(" ", "lng", "lat", c("elev_c") / 100.0))
    lines = view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", text.alias("value"))
    return elevation_points(lines, 3, ["l_orderkey", "l_linenumber"])


@query("dedup_points", "select lng, lat, min(l_orderkey*10+l_linenumber) as first_id from geo_points group by lng, lat")
def dedup_points(spark, sf):
    p = view(spark, sf, "geo_points").withColumn("first_id", c("l_orderkey") * 10 + c("l_linenumber"))
    return binning.first_points(p, "lng", "lat", ["first_id"], 1e-6).select("lng", "lat", "first_id")


@query("point_cap", f"{points_sql(3)} select tx, ty, l_orderkey, l_linenumber, cast(rn as integer) as rank from (select *, row_number() over (partition by tx, ty order by elev_c desc, l_orderkey, l_linenumber) as rn from q_t) where rn <= 32")
def point_cap(spark, sf):
    order = [F.desc("elev_c"), c("l_orderkey"), c("l_linenumber")]
    return binning.cap_points(points(spark, sf, 3), 32, order).select("tx", "ty", "l_orderkey", "l_linenumber", c("rank").cast("int").alias("rank"))


@query("sorted_points", f"{points_sql(2)} select tx, ty, array_to_string(list(l_orderkey || ':' || l_linenumber order by lng, lat, l_orderkey, l_linenumber), ',') as ids from q_t group by tx, ty")
def sorted_points(spark, sf):
    p = points(spark, sf, 2)
    g = p.groupBy("tx", "ty").agg(F.array_sort(F.collect_list(F.struct("lng", "lat", "l_orderkey", "l_linenumber"))).alias("a"))
    return g.select("tx", "ty", F.array_join(F.transform("a", lambda s: F.concat_ws(":", s["l_orderkey"], s["l_linenumber"])), ",").alias("ids"))


@query("edge_thin", "q_s as (select tile, list(distinct v order by v) as vs from (select l_orderkey%50 as tile, cast((l_partkey*37)%1000 as double) as v from lineitem) group by tile) select tile, len(list_reduce(list_transform(vs, lambda v: [v]), lambda a, b: case when b[1]-a[len(a)] > 17.0 then list_concat(a, b) else a end)) as kept from q_s".replace("q_s as", "with q_s as"))
def edge_thin(spark, sf):
    t = table(spark, sf, "lineitem").select((c("l_orderkey") % 50).alias("tile"), ((c("l_partkey") * 37) % 1000).cast("double").alias("v"))
    g = t.groupBy("tile").agg(F.array_sort(F.collect_set("v")).alias("vs"))
    return g.select("tile", F.size(binning.thinned(c("vs"), 17.0)).cast("bigint").alias("kept"))


_POLY = [(-150.0, -60.0), (20.0, -70.0), (160.0, 10.0), (40.0, 20.0), (60.0, 80.0), (-120.0, 50.0), (-20.0, 0.0)]
_CROSS = " + ".join(f"case when ({a[1]} > lat) <> ({b[1]} > lat) and lng < ({b[0]}-({a[0]}))*(lat-({a[1]}))/({b[1]}-({a[1]}))+({a[0]}) then 1 else 0 end" for a, b in zip(_POLY, [*_POLY[1:], _POLY[0]]))


@query("point_in_polygon", f"select l_orderkey, l_linenumber, ({_CROSS}) % 2 = 1 as inside from geo_points")
def point_in_polygon(spark, sf):
    poly = F.array(*[F.struct(lit(x).alias("x"), lit(y).alias("y")) for x, y in _POLY])
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", binning.in_polygon(c("lng"), c("lat"), poly).alias("inside"))


_TRI = ((-100.0, -50.0), (120.0, -50.0), (0.0, 70.0))
_S = [f"(({b[0]})-({a[0]}))*(lat-({a[1]})) - (({b[1]})-({a[1]}))*(lng-({a[0]}))" for a, b in ((_TRI[1], _TRI[2]), (_TRI[2], _TRI[0]), (_TRI[0], _TRI[1]))]


@query("point_triangle", f"select l_orderkey, l_linenumber, case when s0<0 or s1<0 or s2<0 then 'outside' when s1=0 and s2=0 then 'vertex0' when s0=0 and s2=0 then 'vertex1' when s0=0 and s1=0 then 'vertex2' when s0=0 then 'edge0' when s1=0 then 'edge1' when s2=0 then 'edge2' else 'inside' end as relation, round(100*s0/26400.0 + 200*s1/26400.0 + 300*(1-s0/26400.0-s1/26400.0), 6) as height from (select *, {_S[0]} as s0, {_S[1]} as s1, {_S[2]} as s2 from geo_points)")
def point_triangle(spark, sf):
    p, tri = [c("lng"), c("lat")], [[lit(v) for v in q] for q in _TRI]
    r, s, t = binning.barycentric(p, *tri)
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", binning.triangle_relation(p, *tri).alias("relation"), R6(r * 100 + s * 200 + t * 300).alias("height"))


@query("edge_classes", f"{points_sql(4)} select case when fx and fy then 'corner' when fx then 'vertical' when fy then 'horizontal' else 'middle' end as kind, count(*) as n from (select px%256 in (0,255) as fx, py%256 in (0,255) as fy from q_t) group by 1")
def edge_classes(spark, sf):
    fx, fy = (c("px") % 256).isin(0, 255), (c("py") % 256).isin(0, 255)
    kind = F.when(fx & fy, "corner").when(fx, "vertical").when(fy, "horizontal").otherwise("middle")
    return points(spark, sf, 4).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("halo_points", f"{points_sql(6)} select tx+dx as cx, ty+dy as cy, count(*) as n, cast(sum(case when dx=0 and dy=0 then 1 else 0 end) as bigint) as own, cast(sum(elev_c) as bigint) as total from q_t, (values (-1),(0),(1)) a(dx), (values (-1),(0),(1)) b(dy) where tx+dx between 0 and 63 and ty+dy between 0 and 63 group by 1, 2")
def halo_points(spark, sf):
    h = binning.halo(points(spark, sf, 6)).where("cx between 0 and 63 and cy between 0 and 63")
    own = F.sum(F.when((c("dx") == 0) & (c("dy") == 0), 1).otherwise(0)).cast("bigint")
    return h.groupBy("cx", "cy").agg(F.count("*").alias("n"), own.alias("own"), F.sum("elev_c").cast("bigint").alias("total"))


# Pyramids ------------------------------------------------------------------------------------


@query("pyramid_counts", f"{points_sql(8)} " + " union all ".join(f"select {l} as lod, tx>>{8 - l} as tx, ty>>{8 - l} as ty, count(*) as n, cast(sum(elev_c) as bigint) as total from q_t group by 2, 3" for l in range(1, 9)))
def pyramid_counts(spark, sf):
    return pyramid.counts_all_levels(points(spark, sf, 8), 8, value="elev_c")


def _levels(first: str, step: Callable[[str], str], n: int, columns: str) -> str:
    out = [f"q_0 as ({first})"] + [f"q_{k} as ({step(f'q_{k - 1}')})" for k in range(1, n)]
    return ", ".join(out) + " " + " union all ".join(f"select {6 - k} as lod, {columns} from q_{k}" for k in range(n))


_MEAN = ", ".join(f"cast(coalesce(floor(sum(case when a>0 then {x} else 0 end)/nullif(sum(case when a>0 then 1 else 0 end), 0)), 0) as bigint) as {x}" for x in "rgba")


@query("pyramid_color_mean", _levels("select px, py, cast(r as bigint) as r, cast(g as bigint) as g, cast(b as bigint) as b, cast(a as bigint) as a from rgba_cells where ds='A'", lambda q: f"select px>>1 as px, py>>1 as py, {_MEAN} from {q} group by px>>1, py>>1", 6, "px, py, r, g, b, a"))
def pyramid_color_mean(spark, sf):
    base = view(spark, sf, "rgba_cells").where("ds = 'A'").select("px", "py", *[c(x).cast("bigint").alias(x) for x in "rgba"])
    return pyramid.iterate(base, 6, pyramid.color_level).select(c("lod"), "px", "py", *"rgba")


@query("pyramid_raw_mean", _levels("select px, py, cast(v%4096 as double) as v from cells", lambda q: f"select px>>1 as px, py>>1 as py, sum(v)/count(*) as v from {q} group by px>>1, py>>1", 6, "px, py, round(v, 6) as v"))
def pyramid_raw_mean(spark, sf):
    base = view(spark, sf, "cells").select("px", "py", (c("v") % 4096).cast("double").alias("v"))
    return pyramid.iterate(base, 6, pyramid.raw_level).select("lod", "px", "py", R6("v").alias("v"))


@query("pyramid_raw_strict", "select px>>1 as px, py>>1 as py, (sum(cast(v%4096 as double)) + (4-count(*))*-9999.0)/4.0 as v from cells group by px>>1, py>>1")
def pyramid_raw_strict(spark, sf):
    base = view(spark, sf, "cells").select("px", "py", (c("v") % 4096).cast("double").alias("v"))
    return pyramid.raw_level(base, strict=True)


@query("pyramid_children", "select tx>>1 as tx, ty>>1 as ty, count(*) as n_children, cast(sum(pow(2, tx%2+2*(ty%2))) as integer) as mask from (select distinct tx, ty from tiles) group by tx>>1, ty>>1")
def pyramid_children(spark, sf):
    return pyramid.children(view(spark, sf, "tiles").select("tx", "ty").distinct())


# Raster ---------------------------------------------------------------------------------------


def _two(spark, sf):
    t = view(spark, sf, "rgba_cells")
    return [t.where(c("ds") == d).drop("ds") for d in "AB"]


def _merge_sql(first: str, second: str) -> str:
    pick = ", ".join(f"case when x.a > 0 then x.{n} when y.a > 0 then y.{n} else coalesce(x.{n}, y.{n}) end as {n}" for n in "rgba")
    return f"select coalesce(x.px, y.px) as px, coalesce(x.py, y.py) as py, {pick} from (select * from rgba_cells where ds='{first}') x full join (select * from rgba_cells where ds='{second}') y on x.px = y.px and x.py = y.py"


@query("merge_fill", _merge_sql("A", "B"))
def merge_fill(spark, sf):
    return raster.fill(*_two(spark, sf))


@query("merge_overwrite", _merge_sql("B", "A"))
def merge_overwrite(spark, sf):
    return raster.overwrite(*_two(spark, sf))


@query("merge_raw", "q_a as (select px, py, case when v%3=0 then -9999 else v end as v from cells where px < 90), q_b as (select px, py, v%1000 as v from cells where py > 20) select coalesce(q_a.px, q_b.px) as px, coalesce(q_a.py, q_b.py) as py, case when q_a.v is null or q_a.v < -9000 then coalesce(q_b.v, q_a.v) else q_a.v end as filled, coalesce(q_b.v, q_a.v) as overwritten from q_a full join q_b on q_a.px = q_b.px and q_a.py = q_b.py")
def merge_raw(spark, sf):
    t = view(spark, sf, "cells")
    a = t.where("px < 90").select("px", "py", F.when(c("v") % 3 == 0, lit(-9999)).otherwise(c("v")).alias("v"))
    b = t.where("py > 20").select("px", "py", (c("v") % 1000).alias("v"))
    return raster.raw_merge(a, b, "fill").withColumnRenamed("v", "filled").join(raster.raw_merge(a, b, "overwrite").withColumnRenamed("v", "overwritten"), ["px", "py"])


_SAMPLES = "(select distinct l_orderkey*10+l_linenumber as id, cast((l_orderkey*13)%1270 as double)/10 as x, cast((l_partkey*29)%1270 as double)/10 as y from lineitem)"


def _samples(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("l_orderkey*10+l_linenumber as id", "cast((l_orderkey*13)%1270 as double)/10 as x", "cast((l_partkey*29)%1270 as double)/10 as y").distinct()


@query("bilinear_sample", f"select s.id, round((a.v*(1-u)+b.v*u)*(1-w)+(d.v*(1-u)+e.v*u)*w, 4) as value from (select *, x-floor(x) as u, y-floor(y) as w, floor(x) as i, floor(y) as j from {_SAMPLES}) s join cells a on a.px=i and a.py=j join cells b on b.px=i+1 and b.py=j join cells d on d.px=i and d.py=j+1 join cells e on e.px=i+1 and e.py=j+1")
def bilinear_sample(spark, sf):
    return raster.sample(_samples(spark, sf), view(spark, sf, "cells")).select("id", F.round("value", 4).alias("value"))


def _cubic(p: list[str], t: str) -> str:
    a, b, d, e = p
    return f"({b} + ({d} - {a} + ({a}*2 - {b}*5 + {d}*4 - {e} + ({b}*3 - {d}*3 + {e} - {a})*{t})*{t})*{t}*0.5)"


@query("bicubic_sample", f"q_c as (select s.id, s.x, s.y, s.x-floor(s.x) as u, s.y-floor(s.y) as w, {', '.join(f'max(case when a.di={i} and b.dj={j} then c.v end) as v{i + 1}{j + 1}' for j in (-1, 0, 1, 2) for i in (-1, 0, 1, 2))} from {_SAMPLES} s cross join (values (-1),(0),(1),(2)) a(di) cross join (values (-1),(0),(1),(2)) b(dj) join cells c on c.px = cast(floor(s.x) as bigint)+a.di and c.py = cast(floor(s.y) as bigint)+b.dj group by s.id, s.x, s.y having count(*) = 16) select id, round({_cubic([_cubic([f'v{i}{j}' for i in range(4)], 'u') for j in range(4)], 'w')}+1e-7, 3) as value from q_c")
def bicubic_sample(spark, sf):
    return raster.sample(_samples(spark, sf), view(spark, sf, "cells"), "bicubic").select("id", F.round(c("value") + 1e-7, 3).alias("value"))


_ANCHOR = ((10.0, 90.0), (60.0, 95.0), (58.0, 20.0), (12.0, 15.0))


@query("tile_warp", "select tx, ty, " + ", ".join(f"round(({_ANCHOR[0][k]}*(1-tx/255.0)+{_ANCHOR[1][k]}*(tx/255.0))*(1-ty/255.0)+({_ANCHOR[3][k]}*(1-tx/255.0)+{_ANCHOR[2][k]}*(tx/255.0))*(ty/255.0), 6) as {n}" for k, n in ((0, "sx"), (1, "sy"))) + " from unnest(range(0,256)) a(tx), unnest(range(0,256)) b(ty)")
def tile_warp(spark, sf):
    t = spark.range(0, 65536).select((c("id") % 256).alias("tx"), F.floor(c("id") / 256).cast("bigint").alias("ty"))
    return t.select("tx", "ty", *[R6(v).alias(n) for v, n in zip(raster.warp_anchor(c("tx"), c("ty"), _ANCHOR), ("sx", "sy"))])


@query("compose_overlay", "select a.px, a.py, " + ", ".join(f"cast(floor(a.{x}*(a.a/255.0)+b.{x}*(1-a.a/255.0)+0.5) as integer) as unify_{x}, cast(floor(case when a.a>0 then a.{x}*1.0 else b.{x} end+0.5) as integer) as opaque_{x}, cast(floor(a.{x}*(1-b.a/255.0)+b.{x}*(1-(1-b.a/255.0))+0.5) as integer) as overlay_{x}" for x in "rgb") + " from (select * from rgba_cells where ds='A') a join (select * from rgba_cells where ds='B') b on a.px=b.px and a.py=b.py")
def compose_overlay(spark, sf):
    a, b = _two(spark, sf)
    t = a.join(b.select("px", "py", *[c(x).alias(f"b{x}") for x in "rgba"]), ["px", "py"])
    top, base, out = [c(x) for x in "rgb"], [c(f"b{x}") for x in "rgb"], []
    for mode, name in (("unify", "unify"), ("unifyopaque", "opaque"), ("overlay", "overlay")):
        out += [v.alias(f"{name}_{x}") for v, x in zip(jobs.composed(top, c("a"), base, c("ba"), mode), "rgb")]
    return t.select("px", "py", *out)


@query("blend_over", "select a.px, a.py, round(a.a/255.0 + b.a/255.0*(1-a.a/255.0), 6) as alpha, " + ", ".join(f"round(case when a.a/255.0 + b.a/255.0*(1-a.a/255.0) = 0 then 0.0 else (a.{x}/255.0*(a.a/255.0) + b.{x}/255.0*(b.a/255.0)*(1-a.a/255.0))/(a.a/255.0 + b.a/255.0*(1-a.a/255.0)) end, 6) as {x}" for x in "rgb") + " from (select * from rgba_cells where ds='A') a join (select * from rgba_cells where ds='B') b on a.px=b.px and a.py=b.py")
def blend_over(spark, sf):
    a, b = _two(spark, sf)
    t = a.join(b.select("px", "py", *[c(x).alias(f"b{x}") for x in "rgba"]), ["px", "py"])
    mixed = color.over([c(x) / 255.0 for x in "rgb"], c("a") / 255.0, [c(f"b{x}") / 255.0 for x in "rgb"], c("ba") / 255.0)
    return t.select("px", "py", *[R6(v).alias(n) for v, n in zip(mixed, ("r", "g", "b", "alpha"))])


# Terrain ----------------------------------------------------------------------------------------

_W = "q_e as (select px, py, v/100.0 as v from cells), q_w as (select e.px-di as px, e.py-dj as py, " + ", ".join(f"max(case when di={k % 3 - 1} and dj={k // 3 - 1} then v end) as w{k}" for k in range(9)) + " from q_e e, (values (-1),(0),(1)) a(di), (values (-1),(0),(1)) b(dj) group by 1, 2 having count(*) = 9)"
EW, NS = 3000.0, -3000.0


def _windows(spark, sf):
    return terrain.windows(view(spark, sf, "cells").select("px", "py", (c("v") / 100.0).alias("v")))


def _shade_sql(x: str, y: str, k: float, scale: float, azimuth=315.0, altitude=45.0) -> str:
    s, o, z = math.sin(math.radians(altitude)), math.cos(math.radians(altitude)), math.radians(azimuth)
    return f"(select *, ({s!r} - {o!r}*{k!r}*sqrt({x}*{x}+{y}*{y})*sin(atan2({y},{x})-{z!r}))/sqrt(1+{k!r}*{k!r}*({x}*{x}+{y}*{y})) as c, {scale} as s from q_w)"


_HX, _HY = f"(((w0+w3*2+w6)-(w2+w5*2+w8))/{EW})", f"(((w6+w7*2+w8)-(w0+w1*2+w2))/({NS}))"
_ZT = _shade_sql(f"((w3-w5)/{EW})", f"((w7-w1)/({NS}))", 0.5, 254.0)


@query("hillshade_zt", f"{_W} select px, py, cast(case when c<=0 then 1 else floor(1+s*c) end as integer) as shade from {_ZT}")
def hillshade_zt(spark, sf):
    return _windows(spark, sf).select("px", "py", terrain.hillshade(EW, NS).alias("shade"))


@query("hillshade_horn", f"{_W} select px, py, cast(least(case when c<=0 then 1 else floor(1+s*c) end, 255) as integer) as shade from {_shade_sql(_HX, _HY, 0.125, 255.0)}")
def hillshade_horn(spark, sf):
    return _windows(spark, sf).select("px", "py", terrain.hillshade_horn(EW, NS).alias("shade"))


@query("slope_horn", f"{_W} select px, py, round(100*sqrt({_HX}*{_HX}+{_HY}*{_HY})/8, 6) as percent, round(degrees(atan(sqrt({_HX}*{_HX}+{_HY}*{_HY})/8)), 6) as deg from q_w")
def slope_horn(spark, sf):
    return _windows(spark, sf).select("px", "py", R6(terrain.slope(EW, NS)).alias("percent"), R6(terrain.slope(EW, NS, degrees=True)).alias("deg"))


@query("normal_map", f"{_W}, q_n as (select px, py, (w2+w5*2+w8)-(w0+w3*2+w6) as dx, (w6+w7*2+w8)-(w0+w1*2+w2) as dy from q_w) select px, py, cast(floor((dx/sqrt(dx*dx+dy*dy+1e-4)+1)*127.5) as integer) as nx, cast(floor((dy/sqrt(dx*dx+dy*dy+1e-4)+1)*127.5) as integer) as ny, cast(floor((0.01/sqrt(dx*dx+dy*dy+1e-4)+1)*127.5) as integer) as nz from q_n")
def normal_map(spark, sf):
    return _windows(spark, sf).select("px", "py", *[v.alias(n) for v, n in zip(terrain.normal(100.0), ("nx", "ny", "nz"))])


@query("slope_shade", f"{_W}, q_s as (select px, py, (255-{'least(255.0, 100*sqrt(' + _HX + '*' + _HX + '+' + _HY + '*' + _HY + ')/8)'})*0.8 as t, cast(case when c<=0 then 1 else floor(1+s*c) end as integer) as h from {_ZT}) select px, py, round(case when h<180 then greatest(0.0, t-(180-h)/2.0) else least(255.0, t+h-180.0) end, 5) as value from q_s")
def slope_shade(spark, sf):
    s = F.least(lit(255.0), terrain.slope(EW, NS))
    return _windows(spark, sf).select("px", "py", F.round(terrain.slope_shade(s, terrain.hillshade(EW, NS)), 5).alias("value"))


@query("nodata_windows", "q_e as (select px, py, case when v%50=0 then -9999.0 else v/100.0 end as v from cells), q_g as (select e.px-di as px, e.py-dj as py, count(*) as n, min(v) as low from q_e e, (values (-1),(0),(1)) a(di), (values (-1),(0),(1)) b(dj) group by 1, 2) select px, py, low < -1000 as transparent from q_g where n = 9")
def nodata_windows(spark, sf):
    e = view(spark, sf, "cells").select("px", "py", F.when(c("v") % 50 == 0, -9999.0).otherwise(c("v") / 100.0).alias("v"))
    return terrain.windows(e).select("px", "py", terrain.transparent().alias("transparent"))


_G = " ".join(f"when dx={i - 2} and dy={j - 2} then {terrain.GAUSS[j][i]}" for j in range(5) for i in range(5))


@query("gaussian5", f"q_s as (select c.px+dx as px, c.py+dy as py, c.v, case {_G} end as m, dx, dy from cells c, (values (-2),(-1),(0),(1),(2)) a(dx), (values (-2),(-1),(0),(1),(2)) b(dy)), q_g as (select px, py, cast(sum(cast(m*10000 as decimal(20,0))*cast(v as decimal(18,2))) as double)/10000.0 as total, max(case when dx=0 and dy=0 then v end) as own, count(*) as n from q_s group by px, py) select px, py, round(case when n=25 then total else own end, 4) as v from q_g where own is not null")
def gaussian5(spark, sf):
    return terrain.gaussian(view(spark, sf, "cells")).select("px", "py", F.round("v", 4).alias("v"))


_HSV = "(select px, py, e, case when e<400 then 65+65*e/400.0 when e<2000 then 130-100*(e-400)/1600.0 else 30.0 end as h, case when e<2000 then 0.45 else 0.45+0.55*e/9000.0 end as s, 0.5 as v from (select px, py, v/20000.0*3 as e from cells))"


@query("relief_color", f"select px, py, {', '.join(f'cast(floor(greatest(least(({x})*255, 255.0), 0.0)) as integer) as {n}' for n, x in (('r', 'case sec when 0 then v when 1 then q when 2 then p when 3 then p when 4 then t else v end'), ('g', 'case sec when 0 then t when 1 then v when 2 then v when 3 then q else p end'), ('b', 'case sec when 0 then p when 1 then p when 2 then t when 3 then v when 4 then v else q end')))} from (select *, v*(1-s) as p, v*(1-s*f) as q, v*(1-s*(1-f)) as t from (select *, cast(floor(h/60.0) as integer) % 6 as sec, h/60.0-floor(h/60.0) as f from {_HSV}))")
def relief_color(spark, sf):
    e = view(spark, sf, "cells").select("px", "py", (c("v") / 20000.0 * 3).alias("e"))
    return e.select("px", "py", *[v.alias(n) for v, n in zip(terrain.relief_rgb(c("e")), "rgb")])


@query("relief_texture", "select px, py, round(1-t1+1e-9, 6) as desert, round(t1-t2+1e-9, 6) as ground, round(t2-t3+1e-9, 6) as grass, round(t3+1e-9, 6) as snow from (select px, py, greatest(least(e/200.0,1.0),0.0) as t1, greatest(least((e-200)/400.0,1.0),0.0) as t2, greatest(least((e-1300)/900.0,1.0),0.0) as t3 from (select px, py, v/20000.0*3 as e from cells))")
def relief_texture(spark, sf):
    e = view(spark, sf, "cells").select("px", "py", (c("v") / 20000.0 * 3).alias("e"))
    return e.select("px", "py", *[R6(v + 1e-9).alias(n) for v, n in zip(terrain.texture_weights(c("e")), terrain.TEXTURES)])


@query("relief_blend", f"{_W} select px, py, greatest(0.0, cast((px*7+py*3)%256 as double) - (255-cast(case when c<=0 then 1 else floor(1+s*c) end as integer))*0.7) as value from {_ZT}")
def relief_blend(spark, sf):
    pattern = ((c("px") * 7 + c("py") * 3) % 256).cast("double")
    return _windows(spark, sf).select("px", "py", terrain.relief_blend(pattern, terrain.hillshade(EW, NS)).alias("value"))


@query("color_hsv", "q_c as (select distinct r/255.0 as r, g/255.0 as g, b/255.0 as b from cloud), q_m as (select *, greatest(r,g,b) as hi, greatest(r,g,b)-least(r,g,b) as d from q_c), q_h as (select *, (case when d=0 then 0.0 when hi=r then (g-b)/d when hi=g then (b-r)/d+2.0 else (r-g)/d+4.0 end)*60.0 as h from q_m) select round(r,6) as r, round(g,6) as g, round(b,6) as b, round(case when h<0 then h+360.0 else h end, 6) as h, round(case when hi=0 then 0.0 else d/hi end, 6) as s, round(hi, 6) as v from q_h")
def color_hsv(spark, sf):
    t = view(spark, sf, "cloud").select(*[(c(x) / 255.0).alias(x) for x in "rgb"]).distinct()
    return t.select(*[R6(x).alias(x) for x in "rgb"], *[R6(v).alias(n) for v, n in zip(color.rgb_to_hsv("r", "g", "b"), "hsv")])


@query("hillshade_tiles", f"{_W} select px, py, cast(case when c<=0 then 1 else floor(1+s*c) end as integer) as shade from {_ZT}")
def hillshade_tiles(spark, sf):
    tiles = terrain.hillshade_tiles(view(spark, sf, "cells").select("px", "py", (c("v") / 100.0).alias("v")), EW, NS)
    return terrain.shade_cells(tiles)


# Catalog, styles, functions ---------------------------------------------------------------------


@query("ledger_pending", "q_in as (select distinct o_orderpriority as layer, o_orderkey%250 as file_id from orders) select layer, file_id, case when l.finished is null then 'processing' else 'reprocessing' end as status from q_in left join ledger l using (layer, file_id) where coalesce(l.finished, 0) = 0".replace("q_in as", "q_in as"))
def ledger_pending(spark, sf):
    from .catalog import pending

    files = table(spark, sf, "orders").select(c("o_orderpriority").alias("layer"), (c("o_orderkey") % 250).alias("file_id")).distinct()
    state = view(spark, sf, "ledger").select("layer", "file_id", (c("finished") == 1).alias("finished"), lit(False).alias("processing"))
    return pending(files, state, ["layer", "file_id"])


@query("layer_json", "select '{\"name\":\"' || lower(n_name) || '\",\"type\":\"image\",\"format\":\"png\",\"maxlod\":' || n_nationkey || ',\"extent\":[' || n_nationkey || ',' || n_regionkey || ',' || (n_nationkey+7) || ',' || (n_regionkey+9) || ']}' as settings from nation")
def layer_json(spark, sf):
    from .catalog import settings_json

    t = table(spark, sf, "nation").select(F.lower("n_name").alias("name"), lit("image").alias("type"), lit("png").alias("format"), c("n_nationkey").alias("maxlod"), F.array(c("n_nationkey"), c("n_regionkey"), c("n_nationkey") + 7, c("n_regionkey") + 9).alias("extent"))
    return t.select(settings_json().alias("settings"))


_RULES = [{"name": "big", "filter": "[p_size] >= 40", "min": 1e6, "max": 1e8}, {"name": "pair", "filter": "[p_size] = 3 or [p_size] = 4", "min": 0, "max": 1e5}, {"name": "all", "min": 5e8}]


@query("style_filter", " union all ".join(f"select p_partkey, '{r['name']}' as rule, unnest([{', '.join(map(str, jobs.visible_zooms(r.get('min', 0), r.get('max', 1e12))))}]) as zoom from part where {r.get('filter', 'true').replace('[', '').replace(']', '')}" for r in _RULES))
def style_filter(spark, sf):
    return jobs.features_by_rule(table(spark, sf, "part").select("p_partkey", "p_size"), _RULES).select("p_partkey", "rule", "zoom")


@query("math_functions", "select l_orderkey, l_linenumber, round(x-floor(x), 6) as fract, round(x-7*floor(x/7), 6) as floored_mod, round(t*t*(3-2*t), 6) as smooth, round(10*(1-t)+20*t, 6) as mixed, cast(case when x < 3 then 0.0 else 1.0 end - case when x < 30 then 0.0 else 1.0 end as double) as pulse, round(pow(t, ln(0.3)/ln(0.5)), 6) as biased, bit_count(n) = 1 as is_pow2, cast(case when n <= 1 then 1 else pow(2, length(bin(n-1))) end as bigint) as next_pow2 from (select *, greatest(0.0, least(1.0, (x+50)/100.0)) as t from (select l_orderkey, l_linenumber, l_partkey%100-50+l_discount as x, l_partkey%1000+1 as n from lineitem))")
def math_functions(spark, sf):
    t = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey%100-50+l_discount as x", "l_partkey%1000+1 as n").withColumn("t", general.clamp((c("x") + 50) / 100.0))
    return t.select(
        "l_orderkey", "l_linenumber", R6(general.fract("x")).alias("fract"), R6(general.floored_mod("x", lit(7))).alias("floored_mod"), R6(general.smoothstep(lit(-50), lit(50), "x")).alias("smooth"),
        R6(general.mix(lit(10.0), lit(20.0), "t")).alias("mixed"), general.pulse(lit(3), lit(30), "x").alias("pulse"), R6(general.bias(lit(0.3), "t")).alias("biased"),
        general.is_power_of_two("n").alias("is_pow2"), general.next_power_of_two("n").alias("next_pow2"),
    )


@query("path_functions", "select p_partkey, replace(p_brand, '#', '_') || '.' || p_size || '.tif' as file, replace(p_brand, '#', '_') || '.' || p_size as base, 'tif' as ext, '/data/' || p_partkey || '/' as dir, p_partkey % 2 = 1 as web from part")
def path_functions(spark, sf):
    name = F.concat(F.regexp_replace("p_brand", "#", "_"), lit("."), c("p_size").cast("string"), lit(".tif"))
    t = table(spark, sf, "part").select("p_partkey", F.concat(lit("/data//"), c("p_partkey").cast("string"), lit("\\"), name).alias("path"), F.concat(F.when(c("p_partkey") % 2 == 1, "HTTP://h/").otherwise("file:///"), name).alias("url"))
    return t.select("p_partkey", general.file_name("path").alias("file"), general.base_name("path").alias("base"), general.extension("path").alias("ext"), general.directory("path").alias("dir"), general.is_web("url").alias("web"))


@query("base_conversion", "select p_partkey, bin(p_partkey) as binary, lower(hex(p_partkey)) as hexadecimal, p_partkey as back from part")
def base_conversion(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", general.to_base("p_partkey", 2).alias("binary"), general.to_base("p_partkey", 16).alias("hexadecimal"), general.to_base("p_partkey", 36).alias("x"))
    return t.select("p_partkey", "binary", "hexadecimal", general.from_base("x", 36).alias("back"))


@query("streaming_merge", "select px, py, arg_max(v, event_id) as v from arrivals group by px, py")
def streaming_merge(spark, sf):
    import tempfile
    import uuid

    from ..streaming.ingest import ingest, merged

    source = table(spark, sf, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events*.parquet").parquet(sf)
    cells = stream.selectExpr("event_id", "user_id%64 as px", "event_id%64 as py", "cast(round(value*100) as bigint) as v")
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or f"file://{tempfile.gettempdir()}"
    path = f"{base}/quadmill-stream-{uuid.uuid4().hex}"
    ingest(cells, path, ["px", "py"], "event_id", "v")
    return merged(spark, path, ["px", "py"], "event_id", "v")


def _mesh_points(spark, sf):
    p = points(spark, sf, 3)
    return p.select(grid.mercator_x("lng").alias("x"), grid.mercator_y("lat").alias("y"), (c("elev_c") / 1000.0).alias("elevation"), "tx", "ty")


@query("mesh_tiles")
def mesh_tiles(spark, sf):
    from ..operators.mesh import triangulate

    return triangulate(_mesh_points(spark, sf), 3, 64, (0, 0, 7, 7))


@query("mesh_pyramid")
def mesh_pyramid(spark, sf):
    from ..operators.mesh import elevation_level, triangulate

    return elevation_level(triangulate(_mesh_points(spark, sf), 3, 64, (0, 0, 7, 7)), 3, 64)


_TILES_A = "select px, py, r, g, b, cast(a as bigint) as a from rgba_cells where ds = 'A' and a > 0"


@query("tile_archives", _TILES_A)
def tile_archives(spark, sf):
    """Tiles to archives of PNG files, and back to cells."""
    from ..sinks.tiles import archives, png_column, unpacked
    from ..sources.raster import png_tiles

    cells = view(spark, sf, "rgba_cells").where("ds = 'A'").drop("ds")
    tiles = raster.to_blobs(cells, 16).select(lit(2).alias("lod"), "tx", "ty", png_column("rgba", 16).alias("data"))
    back = png_tiles(unpacked(archives(tiles, ".png", 4)))
    return raster.to_cells(back.select("tx", "ty", "rgba"), 16).where("a > 0").select("px", "py", *[c(n).cast("bigint").alias(n) for n in "rgba"])


@query("tile_jpegs")
def tile_jpegs(spark, sf):
    from ..sinks.jpeg import jpeg_column
    from ..sinks.tiles import archives

    cells = view(spark, sf, "rgba_cells").where("ds = 'A'").drop("ds")
    tiles = raster.to_blobs(cells, 16).select(lit(2).alias("lod"), "tx", "ty", jpeg_column("rgba", 16, 85).alias("data"))
    return archives(tiles, ".jpg", 4)


# Other projections, vectors and features ---------------------------------------------------------


def utm_sql(zone: int) -> str:
    """Easting and northing of geo_points in a northern zone."""
    e, up = grid.ECCENTRICITY, " + ".join(f"{a!r}*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, a in enumerate(crs.ALPHA, 1))
    right = " + ".join(f"{a!r}*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, a in enumerate(crs.ALPHA, 1))
    return f"""q_l as (select *, radians(lng - {6 * zone - 183}) as lam, sin(radians(lat)) as s from geo_points where abs(lng - {6 * zone - 183}) <= 6),
q_t as (select *, sinh(atanh(s) - {e!r}*atanh({e!r}*s)) as t from q_l), q_x as (select *, atan2(t, cos(lam)) as xi, atanh(sin(lam)/sqrt(t*t+1)) as eta from q_t)
select l_orderkey, l_linenumber, round({crs.ARC!r}*(eta + {right}) + 500000, 3) as east, round({crs.ARC!r}*(xi + {up}), 3) as north, round(lng, 6) as lng_back, round(lat, 6) as lat_back from q_x"""


@query("utm_transform", utm_sql(33))
def utm_transform(spark, sf):
    p = view(spark, sf, "geo_points").where("abs(lng - 15) <= 6")
    east, north = crs.transform("lng", "lat", 4326, 32633)
    p = p.withColumn("e", east).withColumn("n", north)
    lng, lat = crs.transform("e", "n", 32633, 4326)
    return p.select("l_orderkey", "l_linenumber", F.round("e", 3).alias("east"), F.round("n", 3).alias("north"), R6(lng).alias("lng_back"), R6(lat).alias("lat_back"))


@query("crs_transform", f"select l_orderkey, l_linenumber, round({MX}*pi()*6378137, 3) as x, round({MY}*pi()*6378137, 3) as y, round(pi()*6378137*ln(tan(pi()/4+radians(lat)/2)*pow((1-{grid.ECCENTRICITY}*sin(radians(lat)))/(1+{grid.ECCENTRICITY}*sin(radians(lat))), {grid.ECCENTRICITY / 2}))/pi(), 3) as y_ellipsoid from geo_points")
def crs_transform(spark, sf):
    x, y = crs.transform("lng", "lat", 4326, 3857)
    return view(spark, sf, "geo_points").select("l_orderkey", "l_linenumber", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), F.round(crs.transform("lng", "lat", 4326, 3395)[1], 3).alias("y_ellipsoid"))


@query("vector_math", "with q_v as (select l_orderkey, l_linenumber, l_quantity as a, l_discount*10 as b, l_tax*10 as c, l_linenumber+0.5::double as d from lineitem) select l_orderkey, l_linenumber, round(a*d+b*2+c*3, 6) as dotted, round(b*3-c*2, 6) as cross_x, round(c*d-a*3, 6) as cross_y, round(a*2-b*d, 6) as cross_z, round(a/sqrt(a*a+b*b+c*c), 6) as unit_x, round(-c, 6) as mirrored_z, round(-b+1, 6) as turned_x, round(a+2, 6) as turned_y from q_v")
def vector_math(spark, sf):
    a = [c("l_quantity"), c("l_discount") * 10, c("l_tax") * 10]
    b = [c("l_linenumber") + 0.5, lit(2.0), lit(3.0)]
    cross, turned = linear.cross(a, b), linear.applied(linear.translation(1, 2, 0) @ linear.rotation("z", 90), a)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", R6(linear.dot(a, b)).alias("dotted"), *[R6(v).alias(f"cross_{n}") for n, v in zip("xyz", cross)], R6(linear.normalised(a)[0]).alias("unit_x"),
        R6(linear.reflected(a, [lit(0.0), lit(0.0), lit(1.0)])[2]).alias("mirrored_z"), R6(turned[0]).alias("turned_x"), R6(turned[1]).alias("turned_y"),
    )


_BOXES = "cast((c_custkey*7919)%3000 as double)/10-150 as w, cast((c_custkey*104729)%1100 as double)/10-60 as s, cast(2+c_custkey%5 as double) as dx, cast(1+c_nationkey%4 as double) as dy"
_BOX_SQL = "".join((
    f"with q_f as (select c_nationkey, {_BOXES} from customer), q_w as (select c_nationkey, w, w+dx as e, s, s+dy as n from q_f), ",
    "q_p as (select c_nationkey, ", ", ".join(f"cast(ceil({v}-0.5) as bigint) as {k}" for k, v in (
        ("x0", "(radians(w)/pi()+1)/2*2048"), ("x1", "(radians(e)/pi()+1)/2*2048"), ("y0", "(1-ln(tan(pi()/4+radians(n)/2))/pi())/2*2048"), ("y1", "(1-ln(tan(pi()/4+radians(s)/2))/pi())/2*2048"))),
    " from q_w), q_x as (select c_nationkey, y0, y1, unnest(range(x0, x1)) as px from q_p), q_c as (select c_nationkey, px, unnest(range(y0, y1)) as py from q_x), ",
    "q_m as (select px, py, max(case when c_nationkey < 10 then 100 else 200 end) as r from q_c group by px, py) ",
    "select px >> 8 as tx, py >> 8 as ty, count(*) as painted, cast(sum(r) as bigint) as red from q_m group by all",
))


@query("vector_tiles", _BOX_SQL)
def vector_tiles(spark, sf):
    boxes = table(spark, sf, "customer").selectExpr("c_custkey as feature", "c_nationkey", *_BOXES.split(", "))
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    w, s, e, n = c("w"), c("s"), c("w") + c("dx"), c("s") + c("dy")
    boxes = boxes.withColumn("rings", F.array(F.array(corner(w, s), corner(e, s), corner(e, n), corner(w, n), corner(w, s))))
    rules = [{"filter": "[c_nationkey] < 10", "fill": (100, 0, 0, 255)}, {"filter": "[c_nationkey] >= 10", "fill": (200, 0, 0, 255)}]
    tiles = vector.render_tiles(boxes, rules, range(3, 4)).select("tx", "ty", "rgba")
    return raster.to_cells(tiles).where("a > 0").groupBy(F.shiftright("px", 8).alias("tx"), F.shiftright("py", 8).alias("ty")).agg(F.count("*").alias("painted"), F.sum("r").cast("bigint").alias("red"))


@query("string_functions", "select p_partkey, p_brand || '/' || p_size as kept, substr(p_name, 3, 4) as mid, len(list_filter(regexp_split_to_array(p_type, '[ ,]'), lambda t: t <> '')) as n_tokens, 'h' || p_partkey as host, '/a/' || p_size || '.png' as file, '/data/img/' || p_size || '.tif' as whole, '../img/' || p_size || '.tif' as seen, round(case when p_size < 2 then 1/6.0 else 0.0 end, 6) as spline from part")
def string_functions(spark, sf):
    t = table(spark, sf, "part").withColumn("n", c("p_size").cast("string"))
    url = F.concat(lit("http://h"), c("p_partkey").cast("string"), lit("/a/"), c("n"), lit(".png"))
    whole = general.absolute(lit("/data/dem"), F.concat(lit("../img/"), c("n"), lit(".tif")))
    t = t.withColumn("url", url).withColumn("whole", whole)
    return t.select(
        "p_partkey", F.rtrim(general.delimited(F.concat("p_brand", lit("//"), "n")), lit("/")).alias("kept"), general.middle("p_name", lit(2), lit(4)).alias("mid"), F.size(general.tokens("p_type", " ,")).cast("bigint").alias("n_tokens"),
        general.url_host("url").alias("host"), general.url_file("url").alias("file"), "whole", general.relative("whole", lit("/data/dem")).alias("seen"), R6(general.b_curve(c("p_size") * 1.0)).alias("spline"),
    )


# Files of records, times and table functions -------------------------------------------------------


@query("point_files", f"{points_sql(8)} select cast(8 as integer) as lod, tx, ty, lng as x, lat as y, elev_c/100.0 as elevation from q_t")
def point_files(spark, sf):
    """Points to records of their tile, and back."""
    from ..sinks.tiles import point_records
    from ..sources.raster import point_tiles

    def pack(key, rows):
        data = point_records(rows[["x", "y", "elevation", "weight"]].sort_values(["x", "y", "elevation"]))
        return rows.iloc[:1][["lod", "tx", "ty"]].assign(data=data)

    p = points(spark, sf, 8).select(lit(8).alias("lod"), "tx", "ty", c("lng").alias("x"), c("lat").alias("y"), (c("elev_c") / 100.0).alias("elevation"), lit(1.0).alias("weight"))
    files = p.groupBy("tx", "ty").applyInPandas(pack, "lod int, tx bigint, ty bigint, data binary")
    return point_tiles(files).drop("weight")


@query("voxel_files", "select cast(4 as integer) as lod, i, j, k, (i+0.5::double)/16 as x, (j+0.5::double)/16 as y, (k+0.5::double)/16 as elevation, cast(r as integer) as r, cast(g as integer) as g, cast(b as integer) as b, cast(intensity as integer) as intensity from cloud")
def voxel_files(spark, sf):
    """Colored points to records of their voxel, and back."""
    from ..sinks.records import voxel_records
    from ..sources.records import voxel_points

    place = [((c(v) + lit(0.5)) / 16).alias(n) for v, n in zip("ijk", ("x", "y", "elevation"))]
    return voxel_points(voxel_records(view(spark, sf, "cloud").select(lit(4).alias("lod"), "i", "j", "k", *place, "r", "g", "b", "intensity")))


@query("mesh_files", f"{points_sql(8)} select tx, ty, lng as x, lat as y, elev_c/100.0 as z from q_t")
def mesh_files(spark, sf):
    """Inner points of mesh tiles to mesh files, and back."""
    from ..sinks.records import mesh_records
    from ..sources.records import mesh_tiles

    point = F.struct(c("lng").alias("x"), c("lat").alias("y"), (c("elev_c") / 100.0).alias("z"))
    tiles = points(spark, sf, 8).groupBy("tx", "ty").agg(F.sort_array(F.collect_list(point)).alias("middle"))
    zero = F.struct(*[lit(0.0).alias(n) for n in "xyz"])
    tiles = tiles.select(lit(8).alias("lod"), "tx", "ty", F.array(*[zero] * 4).alias("corners"), *[F.slice("middle", 1, 0).alias(n) for n in ("north", "east", "south", "west")], "middle")
    return mesh_tiles(mesh_records(tiles)).select("tx", "ty", F.explode("middle").alias("p")).select("tx", "ty", "p.x", "p.y", "p.z")


@query("tile_generator", "select c_custkey, tx, unnest(range(c_nationkey%8, c_nationkey%8+2)) as ty from (select c_custkey, c_nationkey, unnest(range(c_custkey%16, c_custkey%16+3)) as tx from customer)")
def tile_generator(spark, sf):
    jobs.register(spark)
    boxes = table(spark, sf, "customer").selectExpr("c_custkey", "c_custkey % 16 as x0", "c_nationkey % 8 as y0").selectExpr("*", "x0 + 2 as x1", "y0 + 1 as y1")
    return spark.sql("select c_custkey, tx, ty from {boxes}, lateral tiles_of(cast(x0 as bigint), cast(y0 as bigint), cast(x1 as bigint), cast(y1 as bigint))", boxes=boxes)


@query("time_texts", "select event_id, strftime(ts, '%Y%m%dT%H%M%S') || case when epoch_us(ts) % 1000000 = 0 then '' else '.' || strftime(ts, '%f') end as iso, strftime(ts, '%Y-%b-%d %H:%M:%S') as stamp, epoch_us(ts) % 86400000000 / 1e6 as seconds, true as same from events")
def time_texts(spark, sf):
    t = table(spark, sf, "events").withColumn("iso", times.iso("ts"))
    return t.select("event_id", "iso", times.stamp("ts").alias("stamp"), times.seconds_between(F.date_trunc("day", "ts"), "ts").alias("seconds"), (times.from_iso("iso") == c("ts")).alias("same"))
