"""Problem 5: the main body of a page without its furniture.

Method: flat text blocks with word count, link density and the like of a block and its
neighbours, classified by decision trees grown on a small labelled table
(:mod:`lakeloom.llm.pagelines`).

Defined results: a null or blank text has no lines and keeps its null or empty body; a null
or empty title has a null or empty headline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.functions.arrow import map_slices
from lakeloom.llm import pagelines as pl, pages as pg
from lakeloom.llm.residue import residue_lines


def main_body(df: DataFrame, lines: pl.LineModel | None = None) -> DataFrame:
    """``df`` with ``headline`` and ``body``: the bare headline and the article's lines.

    Columns of ``df`` with these names are replaced.
    """
    rest = [f for f in df.schema.fields if f.name not in ("headline", "body")]
    names = [f.name for f in rest]
    i, t, x = names.index("domain"), names.index("title"), names.index("text")
    model = lines or pg.line_model(df)

    def factory():
        def kernel(*cols):
            found = model.classify([(text or "", pl.site_name(dom)) for dom, text in zip(cols[i], cols[x])])
            heads, bodies = [], []
            for dom, title, text, page in zip(cols[i], cols[t], cols[x], found):
                heads.append(pl.bare_headline(title, dom, model.sections)[0] if title and title.strip() else title)
                if page:
                    lines = text.split("\n")
                    text = "\n".join(lines[n - 1].rstrip("\r") for n, share, *_ in page if share <= pg.FURNITURE)
                bodies.append(text)
            return [*cols, heads, bodies]

        return kernel

    return map_slices(df, names, StructType([*rest, StructField("headline", StringType()), StructField("body", StringType())]), factory)


def furniture(pages: DataFrame) -> DataFrame:
    """``(doc_id, line_no)``: furniture lines that are no residue, and line 0 for decorated titles outside residue."""
    gone, residue = residue_lines(pages)
    one = pg.records(pages, "furniture", "decorated")
    lines = one.select("doc_id", F.explode("furniture").alias("line_no")).join(residue, ["doc_id", "line_no"], "left_anti")
    titles = one.filter("decorated").select("doc_id", F.lit(0).alias("line_no")).join(gone, "doc_id", "left_anti")
    return lines.unionByName(titles)
