"""The medallion: bronze to silver to gold, and the sales queries around it."""
