"""Every operator as a query over the given tables, with an independent SQL answer."""
