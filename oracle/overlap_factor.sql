select count(*) as hop_windows,
       round(count(*) / (select count(*) from vitals_1m)::double, 2) as overlap_factor
from vitals_hop_1m
