"""Every operator as a query over the star-schema tables, with its SQL twin."""
