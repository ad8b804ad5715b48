"""cropscope: field-imagery and crop analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or
``Column -> Column`` for scalar rules) built from native Spark expressions,
so Catalyst can prune, push down and fuse the whole plan.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming", "session"]
