"""Named queries over the shared tables, each beside the SQL it has to agree with."""


def load_all() -> tuple[dict, dict]:
    import importlib
    import pkgutil

    from tallywright.catalogue.base import ORACLES, QUERIES
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return QUERIES, ORACLES
