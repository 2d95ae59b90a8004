"""Named query plans over the generated tables (see ``registry``)."""

from . import registry  # noqa: F401


def load_all():
    """Import every plan module so that their plans register."""
    from . import columns_plans  # noqa: F401
    for mod in ("profile_plans", "group_plans", "quality_plans", "order_plans", "text_plans", "stats_plans",
                "eval_plans", "ml_plans", "stream_plans", "cluster_plans"):
        try:
            __import__(f"{__name__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{mod}":
                raise
    return registry.PLANS, registry.SQL
