"""The analytical operators, DataFrame in, DataFrame out."""
