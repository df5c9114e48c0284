"""Training-data operators: each module holds one operator, `registry` holds their queries."""
