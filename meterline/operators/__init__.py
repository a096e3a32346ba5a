"""DataFrame operators of the load pipeline and the query layer."""
