"""chronolake: change events in, typed row history and business marts out, all as Spark plans."""
