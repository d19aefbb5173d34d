from . import accents, keywords, text  # noqa: F401
