"""Training-data operators: chat rows, tokens, near copies, leaks, secrets, classifiers and packing."""
