"""DataFrame -> DataFrame operators: windowed metrics, roll-ups, lookup joins.

None of them knows whether its input is a batch or a streaming DataFrame,
except where Spark's streaming rules force a different (equivalent) plan.
"""
