"""Main text of web pages by consensus of a host's pages.

Each page's containers are scored and the best one's path of tags and classes gets the
page's vote, with its score. Votes are added up per host; the host's winning paths
are then used to extract all of its pages again, so that a page whose own scores mislead
follows its siblings.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.llm.page_blocks import parse
from roadwatch.llm.tables import slices, stored

# A path wins with at least this share of its host's votes; so a host has ten at most.
WINNING_SHARE = 0.1


def host_of(url):
    """Lower-case host and port of a URL column; empty without one."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def _vote(batches):
    """A row per path that holds text on a page; the best one's has a vote and its score."""
    for batch in slices(batches, "html"):
        hosts, paths, cast, scores = [], [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parse(source)
            node, score = page.best()
            if score <= 0:
                continue
            best = page.paths[node]
            present = sorted({path for path, held in zip(page.paths, page.held(), strict=True) if held})
            hosts += [host] * len(present)
            paths += present
            cast += [int(path == best) for path in present]
            scores += [float(score) if path == best else 0.0 for path in present]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(cast, pa.int64()), pa.array(scores, pa.float64())],
            names=["host", "path", "vote", "score"],
        )


def winning_paths(pages):
    """One row per host: `paths`, best first, their `votes`, and `losers`, from pages with `host` and `html`.

    Losers are paths that some page votes for and that many of the host's pages have, without
    the votes to win. Votes are added up before the shuffle, so that a host with most pages is no burden.
    Pages without text do not vote, nor do pages without a host, which need not be of one site.
    """
    rows = pages.filter("host <> ''").select("host", "html")
    rows = rows.mapInArrow(_vote, "host string, path string, vote long, score double")
    sums = [F.sum("vote").alias("votes"), F.count("*").alias("present"), F.sum("score").alias("score")]
    counted = stored(rows.groupBy("host", "path").agg(*sums).filter("votes > 0"), "votes")
    totals = stored(counted.groupBy("host").agg(F.sum("votes").alias("total")), "vote-totals")
    least = F.col("total") * WINNING_SHARE
    wins = F.col("votes") >= least
    judged = counted.join(totals, "host").filter(F.col("present") >= least)
    ranked = F.sort_array(F.collect_list(F.when(wins, F.struct("votes", "score", "path"))), asc=False)
    losers = F.sort_array(F.collect_list(F.when(~wins, F.col("path"))))
    by_host = judged.groupBy("host").agg(ranked["path"].alias("paths"), ranked["votes"].alias("votes"), losers.alias("losers"))
    return stored(by_host, "paths")


def _extract(batches):
    columns = ("html", "paths", "votes", "losers")
    for batch in slices(batches, "html"):
        found = [
            parse(source).extract(paths or (), votes or (), losers or ())
            for source, paths, votes, losers in zip(*[batch.column(c).to_pylist() for c in columns], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], names=["page_id", "url", "text"]
        )


def main_text(pages, id_col="page_id", url_col="url", html_col="html"):
    """One row per page: page_id, url, text, n_chars.

    Blocks of the article in page order, joined by an empty line; white space in a block is one
    space. Text around the winning container that belongs to the same run, such as a title and a lead,
    comes with it. Of winning paths with equal weight the one with more votes is taken, then more text
    on the host, then the later name. Very long pages are read whole; the table's other columns stay out. NULL and empty pages, and pages of nothing but navigation, have the text "". Pages
    without a host have their own best container. Repeated rows and NULL ids are pages like others. An empty table
    gives no rows.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    joined = rows.join(winning_paths(rows), "host", "left").select("page_id", "url", "html", "paths", "votes", "losers")
    id_type = rows.schema["page_id"].dataType.simpleString()
    texts = joined.mapInArrow(_extract, f"page_id {id_type}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
