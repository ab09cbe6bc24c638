from txnscope.plans.frames import round_doubles, unpivot, with_scalars, align_columns  # noqa: F401
