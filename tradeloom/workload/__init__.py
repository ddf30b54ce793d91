"""The registered queries: order-processing tables bound to the sources' shapes."""
