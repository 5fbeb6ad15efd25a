"""License scans: sparse TF-IDF cosine of notices to templates, and inheritance from the nearest directory.

Notices are the lines of a whole text that speak of rights. Each distinct line is compared
once, as a sparse vector of its terms weighed by how rare they are among all notices, with
the templates that share a term. A file takes the license of its most similar notice; a
file without one takes that of the nearest directory above it that holds a licence file.
Everything is joins and aggregates of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import cut, table
from cohortlake.operators.skew import join_one_per_key

#: (license, how its notices read); several notices may name one license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("reserved", "All rights reserved."),
)
#: What a line must hold to be a notice, and how like a template it must be.
CUE = r"[Ll]icen[sc]|LICEN[SC]|[Cc]opyright|COPYRIGHT|[Rr]ights [Rr]eserved|RIGHTS RESERVED|SPDX"
SIMILAR = 0.6
TERM = "[^a-z0-9]+"


def terms(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), TERM), "")


def notices(text: Column) -> Column:
    """The notice lines of a whole text with their numbers; none for null."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("no"), x.alias("line")))
    none = F.array().cast("array<struct<no:int,line:string>>")
    return F.when(text.rlike(CUE), F.filter(lines, lambda x: x["line"].rlike(CUE))).otherwise(none)


def likened(lines: DataFrame, templates=TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """``line``, ``license``, ``score`` of each distinct line with its number ``c`` that is like a template; ties go to the first name."""
    spark = lines.sparkSession
    given = spark.createDataFrame(templates, "license string, notice string")
    counted = lines.select("line", "c", F.explode(terms(F.col("line"))).alias("term")).groupBy("line", "c", "term").agg(F.count("*").alias("tf"))
    total = lines.agg(F.sum("c")).first()[0] or 0
    rare = counted.groupBy("term").agg(F.log(F.lit(1.0) + F.lit(total) / F.sum("c")).alias("idf"))
    weighed = counted.join(rare, "term").select("line", "term", (F.col("tf") * F.col("idf")).alias("w"))
    size = weighed.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    asked = given.select("license", "notice", F.explode(terms(F.col("notice"))).alias("term")).groupBy("license", "notice", "term").agg(F.count("*").alias("tf"))
    # A term of a template that no notice has is as rare as one that one notice has.
    asked = asked.join(rare, "term", "left").select(
        "license", "notice", "term", (F.col("tf") * F.coalesce("idf", F.log(F.lit(1.0) + F.lit(total)))).alias("v")
    )
    asked_size = asked.groupBy("license", "notice").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("asked_size"))
    dots = weighed.join(asked, "term").groupBy("line", "license", "notice").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scores = dots.join(size, "line").join(asked_size, ["license", "notice"])
    score = F.round(F.col("dot") / (F.col("size") * F.col("asked_size")), 6).alias("score")
    best = scores.select("line", "license", score).where(F.col("score") >= similar)
    best = best.groupBy("line").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    return best.select("line", "b.license", (-F.col("b.s")).alias("score"))


def ancestors(path: Column) -> Column:
    """Directories above a path, the root as empty text, with their depth; none for null."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("dir")))


def scanned(files: DataFrame, templates=TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``files`` (``doc_id``, ``path``, ``text``, ``is_licence``): ``doc_id``, ``path``,
    ``own`` license with its ``score`` and ``line_no``, ``inherited`` license with the directory ``inherited_from``,
    and ``license``, the first of the two.

    Null texts have no notice; a null path has no directory. Of several licence files in
    a directory the most similar counts, then the smallest doc_id (null last), then the
    first name. Repeated rows stay. Extra columns are left out; an empty table gives no rows.
    """
    # Row numbers are fixed by the cut: everything below reads them from the written rows.
    rows = cut(
        files.select("doc_id", "path", F.coalesce("is_licence", F.lit(False)).alias("is_licence"), notices(F.col("text")).alias("found"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    each = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.no", "x.line")
    best = likened(each.groupBy("line").agg(F.count("*").alias("c")), templates, similar)
    own = join_one_per_key(each, best, "line").groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("s"), "no", "license")).alias("o"))
    own = cut(own.select("row", F.col("o.license").alias("own"), (-F.col("o.s")).alias("score"), F.col("o.no").cast("long").alias("line_no")))
    known = rows.drop("found").join(own, "row", "left")
    at = F.element_at(ancestors(F.col("path")), -1)["dir"]
    lawful = known.where("is_licence and own is not null and path is not null")
    first = F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("n"), "doc_id", F.col("own").alias("license"))
    held = lawful.groupBy(at.alias("dir")).agg(F.min(first).alias("f")).select("dir", F.col("f.license").alias("above"))
    below = known.where("own is null and path is not null").select("row", F.explode(ancestors(F.col("path"))).alias("a")).select("row", "a.depth", "a.dir")
    near = join_one_per_key(below, held, "dir").groupBy("row").agg(F.max(F.struct("depth", "dir", "above")).alias("m"))
    near = near.select("row", F.col("m.above").alias("inherited"), F.col("m.dir").alias("inherited_from"))
    out = known.join(near, "row", "left")
    return out.select("doc_id", "path", "own", "score", "line_no", "inherited", "inherited_from", F.coalesce("own", "inherited").alias("license"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, language and hundreds of doc_id are directories.

    A document with a notice in its first two lines is a licence file; by its number it lies in the
    hundred's, the language's or the source's directory.
    """
    top, lang, hundred = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(F.col("doc_id") / 100).cast("string")
    is_licence = F.coalesce(F.regexp_extract(F.col("text"), r"^[^\n]*\n?[^\n]*", 0).rlike(CUE), F.lit(False))
    name = F.when(is_licence, "LICENSE").otherwise(F.lit("text"))
    file = F.concat_ws("-", name, F.col("doc_id").cast("string"))
    deep = F.when(~is_licence | (F.col("doc_id") % 3 == 0), F.concat_ws("/", top, lang, hundred, file))
    path = deep.when(F.col("doc_id") % 3 == 1, F.concat_ws("/", top, lang, file)).otherwise(F.concat_ws("/", top, file))
    return docs.select("doc_id", path.alias("path"), "text", is_licence.alias("is_licence"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scanned(as_files(table(spark, folder, "documents")))


OP5_SQL = r"""
with given(license, notice) as (values
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'), ('BSD-3-Clause', 'Released under the BSD 3-Clause License.'),
  ('CC-BY-4.0', 'Licensed under CC BY 4.0.'), ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
  ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
  ('LGPL-3.0', 'This work is licensed under the GNU Lesser General Public License, version 3.'), ('MIT', 'Released under the MIT License.'),
  ('MPL-2.0', 'This work is subject to the terms of the Mozilla Public License, version 2.0.'), ('reserved', 'All rights reserved.')
), cue(c) as (values ('[Ll]icen[sc]|LICEN[SC]|[Cc]opyright|COPYRIGHT|[Rr]ights [Rr]eserved|RIGHTS RESERVED|SPDX')
), files as (
  select doc_id, coalesce(source, 'none') as s, coalesce(lang, 'none') as l, string_split(coalesce(text, ''), chr(10)) as lines,
         regexp_matches(array_to_string(string_split(coalesce(text, ''), chr(10))[1:2], chr(10)), (select c from cue)) as lawful
  from documents
), placed as (
  select *, case when not lawful or doc_id % 3 = 0 then concat_ws('/', s, l, doc_id // 100) when doc_id % 3 = 1 then concat_ws('/', s, l) else s end as dir,
         concat(case when lawful then 'LICENSE' else 'text' end, '-', doc_id) as file
  from files
), each as (
  select doc_id, i - 1 as line_no, lines[i] as line from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as i from placed)
  where regexp_matches(lines[i], (select c from cue))
), bag as (
  select line, term, count(*) as tf from (
    select line, unnest(regexp_split_to_array(lower(line), '[^a-z0-9]+')) as term from (select distinct line from each)) where term <> '' group by all
), rare as (
  select term, ln(1.0 + (select count(*) from each) / sum(c)) as idf
  from bag join (select line, count(*) as c from each group by line) using (line) group by term
), vec as (select line, term, tf * idf as w from bag join rare using (term)
), asked as (
  select license, term, count(*) * coalesce(any_value(idf), ln(1.0 + (select count(*) from each))) as v
  from (select license, unnest(regexp_split_to_array(lower(notice), '[^a-z0-9]+')) as term from given) left join rare using (term) where term <> '' group by all
), scores as (
  select line, license, round(sum(w * v) / (any_value(ls) * any_value(ts)), 6) as score
  from vec join asked using (term) join (select line, sqrt(sum(w * w)) as ls from vec group by line) using (line)
  join (select license, sqrt(sum(v * v)) as ts from asked group by license) using (license) group by line, license
), best as (
  select * from scores where score >= 0.6 qualify row_number() over (partition by line order by score desc, license) = 1
), own as (
  select * from each join best using (line) qualify row_number() over (partition by doc_id order by score desc, line_no, license) = 1
), known as (
  select p.doc_id, p.dir, p.file, p.lawful, o.license as own, o.score, o.line_no from placed p left join own o using (doc_id)
), held as (
  select dir, own as above from known where lawful and own is not null qualify row_number() over (partition by dir order by score desc, doc_id) = 1
), near as (
  select k.doc_id, h.above, h.dir from known k join held h on k.dir = h.dir or starts_with(k.dir, h.dir || '/')
  where k.own is null qualify row_number() over (partition by k.doc_id order by length(h.dir) desc) = 1
)
select k.doc_id, k.dir || '/' || k.file as path, k.own, k.score, k.line_no, n.above as inherited, n.dir as inherited_from, coalesce(k.own, n.above) as license
from known k left join near n using (doc_id)
"""
