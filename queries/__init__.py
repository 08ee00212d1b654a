"""The registered queries: each runs the library over items or changes built from the tables."""
