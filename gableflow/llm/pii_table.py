"""The small labelled table of the personal-data model: made-up lines, labelled spans as [kind text]."""

#: Labelled lines, none of them about real persons.
LINES = """\
write to [email jane.doe at mailbox dot org] before noon
reach me at [email sam (at) example (dot) net] any day
contact: [email info [at] widgets [dot] com] for prices
send it to [email k.miller@localhost] please
his address is [email ana_b at posteo dot de] or so
mail [email lee.w (at) corp.example.com] and wait
ask [email root@server7] about the disk
my mail is [email tom99 at web dot net], write soon
[email zoe (at) uni (dot) edu] sent the list
forward to [email j.roe at example.com] today
call [phone 555-010-4477] after six
call me: [phone (555) 010-7788] or later
tel [phone 030 5550 1234] office
phone: [phone 555.010.2244] home
fax [phone 020-5550-9911], second floor
ring [phone (020) 5550 1188] at night
the number is [phone 1-800-555-0199] toll free
mobile [phone 0171 555 0123]
tel. [phone 0044 20 5550 1234] in London
call [phone 555 010 9988], ask for Ann
[phone (415) 555-0134] is the desk
phone [phone 555-0145-22] weekdays
host [ip 10 . 0 . 12 . 7] is down
ip [ip 192,168,4,20] did not answer
server at [ip 172-16-30-5] restarts
the box [ip 10 . 1 . 2 . 3] again
card [card 4111.1111.1111.1111] was used
paid with [card 5500/0000/0000/0004] online
card number [card 4012  8888  8888  1881] expired
visa [card 3782.822463.10005] on file
Licensed under the Apache License, Version 2.0.
under the GNU General Public License, version 3.
Licensed under CC BY-NC 4.0.
version 1.12.3 came out in 2019
on 2021-03-14 the price was 19.99 and rose
from 12:30 to 14:45 on 03/04/2020
about 1,250,000 people in 1998 and 2004
chapter 3.2.1 and section 12 of 44
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" was lost
token = "5d190bd7c06284de91015a36974748794293dd8a"
key 9f86d081884c7d65 and id 4829174
the order 8472910 has 12 parts and 300 screws
page 12, page 13, and page 14 of 200
ISBN 978 is not 979 and 10 is not 13
we met at the old house at noon and left at two
look at the dot on the map at once
it is at rest, at home, or at work.
the | and | of | in | that | was | for | are
und die der das in zu von mit ist im
de la que el en y los un por con
le la les des et un une du en que
Lyon, 43. Rue des Lilas 12, second door
flat 4, 221 Baker Street, and 10 more
ratio 3:2, score 7-1, range 10-20 and 5-15
a + b = c and 2 + 2 = 4 or 1 + 1
x@ and @y are not, nor is @ alone
the team (of 12) won 3 (three) times
THE ERED, NDENOR!! THAT!! OF!!
Is and retitioning the of, nterti thorreou ndernt.
$ 4.50 per unit, 30 % off, # 7
1 2 3 4 5 6 7 8 9 10 11 12
100 200 300 and 400 500 600 in rows
temperatures: 12.5 13.0 11.8 9.4 degrees
2.3.4 is older than 2.4.1 and 3.0.0
0.5 - 0.7 - 0.9 and 1.1
1234567890 and 9876543210 are sums
4485 7720 and 3391 were the codes
line 1: 20-30; line 2: 40-50
ask [email anna at home dot org] for it
or [email peter dot stone at place dot com] instead
[email maria at post dot example dot net] has the keys
her mail: [email kim (at) club (dot) org], his: [email lou at team dot net]
mail me at [email ben [at] studio [dot] eu] please
email [email nora_k at firm dot co dot uk] before five
you can write [email otto at verlag dot de] or call
ring [phone 0800 123 4567] any time
or ring [phone 0345 600 1122] for help
phone [phone 01632 960 123] and ask
call us on [phone 0113 496 0999] today
tel [phone (0161) 496 0345], room 9
mobile: [phone 07700 900 461]
fax: [phone 212.555.0173]
her number is [phone 415-555-0162] at work
dial [phone 1 (800) 555 0111] for sales
reach us: [phone 202 555 0148]
the host [ip 172 . 16 . 0 . 9] answers
ip address [ip 192 . 168 . 1 . 77] is taken
server [ip 10,20,30,40] and server [ip 10-20-30-41]
ping [ip 8 . 8 . 4 . 4] from there
version 1 . 2 . 3 . 4 is out
version 10,0,2,1 and build 4,4,0,9
release 2 . 0 . 1 . 7 fixes it
chapter 1 . 2 . 3 . 4 of the book
section 4 . 2 . 1 . 3 says so
card [card 6011.0009.9013.9424] expires
mastercard [card 5105/1051/0510/5100] was refused
pay with [card 4222 2222 2222 2000] or cash
at home and at the place the dot was seen
she sat at a table, dot or no dot, at ten
look at dot com firms and at net gains
meet at noon at place number 4
in 2004 and 2005 600 1122 parts were made
order 0800 of lot 123 and lot 4567
rooms 212, 555 and 173 are free
from 1990 to 1995, 200 to 300 a year
"""
