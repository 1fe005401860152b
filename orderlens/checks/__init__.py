"""Every operator as a named query over the star tables, with its SQL counterpart."""
