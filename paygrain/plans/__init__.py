"""Declarative catalogues, the pipeline that folds over them, sessions."""
