"""DataFrame-to-DataFrame operators: derive, check, model, aggregate, audit."""
