"""Transforms of tenants, looked up by the name in their agreement."""

_transforms = {}


def register_pipeline(name, fn, tenant=None, location=None):
    """Register a DataFrame -> DataFrame function under a name.

    With ``tenant`` and ``location`` it serves only the files of that staging location.
    """
    _transforms[(name, tenant, location)] = fn


def transform_for(name, tenant=None, location=None):
    """The function registered for the location, else the one of that name."""
    for key in ((name, tenant, location), (name, None, None)):
        if key in _transforms:
            return _transforms[key]
    raise KeyError(f"no transform registered as {name!r}")


def run_tenant(name, df, tenant=None, location=None):
    return df.transform(transform_for(name, tenant, location))
