"""The data behind every report page: ``f(mart, ...) -> DataFrame``."""
