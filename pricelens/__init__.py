"""pricelens: a Spark-native retail catalogue engine.

Stored shop pages -> shredded DOM nodes -> typed product records -> quality
split (rejects with a reason) -> published catalogue (JSON lines, date
partitioned files, appendable tables, batch or Structured Streaming) ->
price-comparison queries over the result.
"""

from pricelens.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
