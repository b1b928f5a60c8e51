"""netsounder: network, spatial and corpus analytics declared as Spark plans."""
