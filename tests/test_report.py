"""Page report layout and the ordered text sink."""

import glob
import os
import re
import tempfile

from conftest import SF001
from quarry.operators import lookup
from quarry.operators.links import child_links, parent_links
from quarry.operators.report import BLOCK_SEPARATOR, page_blocks, write_page_report
from quarry.plans.catalog import crawl_index

# The line layout of one report block.
PREFIXES = ("Page title: ", "URL: ", "Last Modification Date: ", "Size: ", "Keywords: ", "Parent Links: ", "Child Links: ")


def test_report_blocks_and_sink(spark):
    c = crawl_index(spark, SF001)
    blocks = page_blocks(
        c.tree, c.index.pages, lookup.top_keywords(c.index), parent_links(c.tree, c.snapshot), child_links(c.tree, c.snapshot)
    )
    rows = sorted(blocks.collect(), key=lambda r: r.visit_order)
    assert [r.visit_order for r in rows] == list(range(1, len(rows) + 1))
    for r in rows:
        lines = r.block.split("\n")
        head, children = lines[:7], lines[7:]
        assert all(line.startswith(p) for line, p in zip(head, PREFIXES))
        assert re.fullmatch(r"Size: \d+ bytes", head[3])
        kws = re.findall(r"(\S+?)\((\d+)\)", head[4][len("Keywords: "):])
        assert len(kws) == 5
        counts = [int(n) for _, n in kws]
        assert counts == sorted(counts, reverse=True)
        assert len(children) + 1 <= 10
    assert rows[0].block.split("\n")[5] == "Parent Links: None"
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-report-"), "report")
    write_page_report(blocks, out)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(os.path.join(out, "part-*"))))
    parts = text.split("\n" + BLOCK_SEPARATOR + "\n")
    assert len(parts) == len(rows)
    assert parts[0] == rows[0].block and parts[-1] == rows[-1].block + "\n"
